"""Registered queries next to their SQL on the smallest documents."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from promolens.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, name):
    result, _ = compare(spark, connect(sf), name, QUERIES[name], ORACLES[name], sf)
    assert result.startswith("ok"), result


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
