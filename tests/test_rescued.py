"""CSV rows that cannot be read whole: one parse, the same table as before, every reject listed."""

import pytest

from promolens.sinks.tables import load_from_csv
from promolens.sources.rescued import load_csv_rescued, read_rejects
from promolens.sources.tables import unread_values

DDL = "id bigint, day date, amount double, note string"
TEXT = """id,amount,day,note,extra
1,2.5,2024-01-01,fine,x
2.0,,2024-01-02,"a, b",x
three,1,2024-01-03,bad id,x
4,1e400x,31/02/2024,two bad,x
5,1,2024-01-05
6,1,2024-01-06,long,x,y
,,NaT,,
"""


@pytest.fixture
def csv(tmp_path):
    (tmp_path / "in.csv").write_text(TEXT)
    return str(tmp_path / "in.csv")


def test_table_is_unchanged_and_rejects_are_listed(spark, csv, tmp_path):
    old, new, bad = (str(tmp_path / n) for n in ("old", "new", "bad"))
    load_from_csv(spark, csv, old, DDL)
    seen = load_csv_rescued(spark, csv, new, DDL, bad)
    rows = sorted(map(str, spark.read.schema(DDL).parquet(new).collect()))
    assert rows == sorted(map(str, spark.read.schema(DDL).parquet(old).collect())) and len(rows) == 7
    assert seen == {"rows": 7, "fields": 2, "id": 1, "day": 2, "amount": 1, "note": 0}
    assert {k: v for k, v in seen.items() if k not in ("rows", "fields")} == unread_values(spark, csv, DDL).first().asDict()
    got = {r.raw["id"]: (r.file, sorted(r.reasons), r.line) for r in read_rejects(spark, bad).collect()}
    assert got == {
        "three": ("in.csv", ["id"], None),
        "4": ("in.csv", ["amount", "day"], None),
        "5": ("in.csv", ["fields"], "5,1,2024-01-05"),
        "6": ("in.csv", ["fields"], "6,1,2024-01-06,long,x,y"),
        None: ("in.csv", ["day"], None),
    }
    assert {r.raw["amount"] for r in read_rejects(spark, bad).where("raw['id'] = '4'").collect()} == {"1e400x"}


def test_a_clean_file_replaces_earlier_rejects(spark, csv, tmp_path):
    new, bad = str(tmp_path / "new"), str(tmp_path / "bad")
    load_csv_rescued(spark, csv, new, DDL, bad)
    (tmp_path / "clean.csv").write_text("note,day,amount,id\nq,2024-01-01,1,1\n")
    seen = load_csv_rescued(spark, str(tmp_path / "clean.csv"), new, DDL, bad)
    assert seen["rows"] == 1 and read_rejects(spark, bad).count() == 0 and spark.read.parquet(new).count() == 1


def test_a_file_with_a_header_only(spark, tmp_path):
    (tmp_path / "none.csv").write_text("id,day,amount,note\n")
    seen = load_csv_rescued(spark, str(tmp_path / "none.csv"), str(tmp_path / "t"), DDL, str(tmp_path / "b"))
    assert seen["rows"] == 0 and read_rejects(spark, str(tmp_path / "b")).count() == 0
