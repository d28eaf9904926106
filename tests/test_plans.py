"""The physical plans are the ones meant: no cross joins, no Python, small shuffles, pruned scans."""

from __future__ import annotations

import re

import pytest

from meterlake.harness import inputs
from meterlake.harness.queries import QUERIES
from meterlake.plans import silver

PURE = [
    name for name in QUERIES
    if name not in {"csv_ingest", "medallion_roundtrip", "layer_audit", "csv_malformed"}
    and not (name.startswith("ml_") and name not in {"ml_load_shape", "ml_load_shape_l1", "ml_forecast_features"})
    and name not in {"tile_8_segments", "segment_consumption"}
]


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_no_cross_join_python_or_global_window(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Window", "InMemoryRelation"):
        assert operator not in text


def test_copies_collapse_before_the_shuffle(spark, sf_dir):
    text = plan(silver.clean_readings(inputs.raw_readings(spark, sf_dir)))
    assert text.index("functions=[min(") < text.index("Exchange hashpartitioning") < text.index("partial_min")
    assert text.count("Exchange") == 1


def test_scans_read_only_what_a_query_needs(spark, sf_dir):
    def columns(name):
        found = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, sf_dir)))
        return [{part.split(":")[0] for part in one.split(",")} for one in found]

    assert columns("gold_load_profile") == [{"ts", "value"}]
    assert columns("dedup_by_key") == [{"l_orderkey", "l_linenumber", "l_quantity"}]
    assert {"o_custkey", "o_totalprice", "o_orderdate"} in columns("tile_9_top_households")


def test_top_k_does_not_sort_everything(spark, sf_dir):
    for name in ("tile_9_top_households", "finding_peak_slots"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "TakeOrderedAndProject" in text
        assert "rangepartitioning" not in text


def test_day_totals_join_days_not_meter_days(spark, sf_dir):
    text = plan(QUERIES["gold_daily_totals"](spark, sf_dir))
    joins = [m.start() for m in re.finditer(r"Join \[day", text)]
    assert joins and max(joins) < text.index("partial_sum(daily_kwh")


def test_group_profile_median_is_not_kept_per_meter(spark, sf_dir):
    text = plan(QUERIES["gold_group_profile"](spark, sf_dir))
    for line in text.splitlines():
        if "percentile_approx" in line and "Aggregate" in line:
            assert "meter_id" not in line


def test_reference_check_counts_before_it_joins(spark, sf_dir):
    from meterlake.plans.quality import orphans

    frame = orphans(inputs.readings(spark, sf_dir), inputs.households(spark, sf_dir), "meter_id", "x")
    text = plan(frame)
    assert text.index("Join [meter_id") < text.index("partial_count(1)")
