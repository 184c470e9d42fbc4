"""Shards that changed, came or went, told from listings; the others are not read."""

import pytest
from pyspark.sql import functions as F

from promolens.session import work_dir
from promolens.sinks.versions import Files
from promolens.sources.fingerprints import ShardLedger, shard_content, shard_listing
from tests.data import CFG

DDL = "id bigint, items array<struct<n:string>>, ds string"


def shards(spark, rows):
    return spark.createDataFrame([(i, [(f"n{i}",)], ds) for ds, ids in rows.items() for i in ids], DDL)


def put(spark, path, rows):
    shards(spark, rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ds").parquet(path)


@pytest.fixture
def folders(spark):
    root = work_dir(spark)
    return f"{root}/daily", f"{root}/intraday", ShardLedger(spark, f"{root}/ledger", CFG)


def told(ledger, *paths):
    return {r.ds: r.change for r in ledger.changes(*paths, DDL).collect()}


def test_changes(spark, folders):
    daily, intraday, ledger = folders
    put(spark, daily, {"20240101": [1, 2], "20240102": [3], "20240103": [4, 4]})
    put(spark, intraday, {"20240103": [9], "20240104": [5, 6], "20240105": [7], "20231231": [8]})
    first = {f"2024010{i}": "added" for i in range(1, 6)}
    assert told(ledger, daily, intraday) == first == told(ledger, daily, intraday)
    ledger.commit()
    assert told(ledger, daily, intraday) == {}
    put(spark, daily, {"20240102": [3], "20240103": [4, 4, 4], "20240104": [5, 6], "20240105": [70]})
    Files(spark, daily).remove(f"{daily}/ds=20240101")
    # Written again with equal rows, or moved from intraday to daily with equal rows: no change.
    assert told(ledger, daily, intraday) == {"20240101": "removed", "20240103": "changed", "20240105": "changed"}
    ledger.commit()
    assert told(ledger, daily, intraday) == {}
    # An intraday shard behind a daily one does not count.
    put(spark, intraday, {"20240103": [1]})
    assert told(ledger, daily, intraday) == {}


def test_other_shards_are_not_read(spark, folders):
    daily, intraday, ledger = folders
    put(spark, daily, {"20240101": [1], "20240102": [2]})
    told(ledger, daily, intraday)
    ledger.commit()
    # A broken file with the recorded listing: reading it would fail.
    entry = shard_listing(spark, daily, "daily", CFG).where("ds = '20240101'")
    name = [n for n in Files(spark, daily).names(f"{daily}/ds=20240101") if n.endswith(".parquet")][0]
    Files(spark, daily).create(f"{daily}/ds=20240101/{name}", "not parquet")
    listing = entry.select("listing").first()[0]
    seen = ledger.known().withColumn("listing", F.when(F.col("ds") == "20240101", F.lit(listing)).otherwise(F.col("listing")))
    ledger.table.replace(seen)
    put(spark, daily, {"20240102": [2, 3]})
    assert told(ledger, daily, intraday) == {"20240102": "changed"}


def test_content_counts_repeated_rows_in_any_order(spark):
    def of(*ids):
        return shard_content(shards(spark, {"d": ids}).repartition(2)).drop("ds").first()

    assert of(1, 2, 3) == of(3, 1, 2) and of(1, 1, 2) != of(2) and of(1, 1) != of(2, 2) and of(1) != of(1, 1, 1)


def test_no_shards(spark, folders):
    daily, intraday, ledger = folders
    with pytest.raises(ValueError):
        ledger.commit()
    assert told(ledger, daily, intraday) == {}
    put(spark, daily, {"20240101": [1]})
    assert told(ledger, daily, intraday) == {"20240101": "added"}
