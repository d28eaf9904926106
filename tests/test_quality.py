"""Contract checks on tables that break them."""

from __future__ import annotations

from frames import rows

from meterlake import tables as t
from meterlake.plans import quality


def test_duplicate_keys_counts_keys_not_rows(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", 1), ("b", 2), (None, 1), (None, 1)], "k string, n int")
    assert rows(quality.duplicate_keys(frame, ["k", "n"], "x")) == [("primary_key", "x", 2)]
    assert rows(quality.duplicate_keys(frame.limit(0), ["k"], "x")) == [("primary_key", "x", 0)]


def test_orphans_count_rows_and_ignore_null_keys(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("d",)], "k string")
    assert rows(quality.orphans(child, parent, "k", "c -> p")) == [("foreign_key", "c -> p", 3)]
    assert rows(quality.orphans(parent.limit(0), parent, "k", "c -> p")) == [("foreign_key", "c -> p", 0)]


def test_outside_domains(spark):
    frame = spark.createDataFrame([(0, 1), (47, 1), (48, 0), (-1, 2), (None, 1)], "half_hour int, flag int")
    rules = {"half_hour": "half_hour BETWEEN 0 AND 47", "flag": "flag IN (0, 1)"}
    assert rows(quality.outside_domains(frame, rules, "x")) == [
        ("domain:flag", "x", 1), ("domain:half_hour", "x", 3),
    ]


def test_schema_differences(spark):
    frame = spark.createDataFrame([], "half_hour long, avg_kwh double, extra string")
    assert quality.schema_differences(frame, t.GOLD_LOAD_PROFILE) == [
        "clock_time is missing", "extra is not declared", "half_hour is bigint, declared int",
    ]


def test_dictionary_is_consistent():
    assert len(t.TABLES) == 20
    assert len({(x.layer, x.name) for x in t.TABLES}) == 20
    for table in t.TABLES:
        names = {c.name for c in table.columns}
        assert len(names) == len(table.columns)
        assert set(table.key) <= names
        assert set(table.domains) <= names
        assert {table.bucketed_by or table.columns[0].name} <= names
        assert table.partitioned_by == tuple(c.name for c in table.columns)[len(table.columns) - len(table.partitioned_by) :]
    for child, parent, key in t.REFERENCES:
        assert key in {c.name for c in child.columns}
        assert parent.key == (key,)
