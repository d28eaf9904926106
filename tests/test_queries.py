"""Every registered query against its SQL twin, or for rows where it has none."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences

from __spark_entry__ import entry
from meterlake.harness.oracles import ORACLES
from meterlake.harness.queries import QUERIES

NO_SQL = {
    "tile_8_segments", "view_tile_8_segments", "segment_consumption", "ml_silhouette_sweep", "ml_segments", "ml_segment_curves",
    "ml_forecast", "ml_forecast_metrics", "ml_feature_importance",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_but_the_models_has_a_twin():
    assert set(QUERIES) - set(ORACLES) == NO_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_models_return_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_views_of_a_lake_have_weather(spark, sf_dir):
    days = QUERIES["views_demand"](spark, sf_dir)
    assert days.filter("temp_avg IS NOT NULL").count() > 0


def test_readings_come_from_several_files(spark, sf_dir):
    assert QUERIES["csv_ingest"](spark, sf_dir).select("source_file").distinct().count() == 5


def test_entry(spark):
    frame = entry(spark)
    assert frame.count() > 0
    assert "avg_kwh_per_home" in frame.columns
