"""Ratios whose denominator is 0 are null, also under ANSI rules."""

from __future__ import annotations

import math

from frames import rows

from meterlake.plans import dashboard, findings, forecast, silver


def test_gap_above_zero(spark):
    frame = spark.createDataFrame([("a", 0.0), ("b", 2.0)], "name string, kwh double")
    assert rows(findings.gap(frame, "name", "kwh")) == [("b", 2.0, "a", 0.0, None)]


def test_season_gap_above_zero(spark):
    frame = spark.createDataFrame([("Winter", 1.0), ("Summer", 0.0)], "season string, avg_per_home double")
    assert findings.season_gap(frame).first().gap_pct is None


def test_r2_of_equal_days(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "actual double, prediction double")
    scored = forecast.metrics(frame).first()
    assert scored.r2 is None and scored.mae == 0.5


def test_segment_without_measured_days(spark):
    daily = spark.createDataFrame([("m", None)], "meter_id string, energy_sum double")
    segments = spark.createDataFrame([("m", 1)], "meter_id string, segment int")
    assert rows(dashboard.segment_consumption(daily, segments)) == [(1, 1, None)]


def test_a_meter_with_two_tariffs_is_one_household(spark):
    fact = spark.createDataFrame(
        [("m", 1.0, "Standard", "A"), ("m", 3.0, "Time-of-Use", None)], "meter_id string, daily_kwh double, tariff string, detail_code string"
    )
    assert rows(dashboard.top_households(fact)) == [("m", 2.0, "Time-of-Use", "A")]


def test_groups_are_trimmed_and_filled_rows_stay(spark):
    listed = [("m", None, None, None), ("m", "ToU", "ACORN-A", " Affluent "), ("n", "Std", "ACORN-Q", " ACORN-U ")]
    frame = spark.createDataFrame(listed, "LCLid string, stdorToU string, Acorn string, Acorn_grouped string")
    found = silver.clean_households(frame).select("meter_id", "tariff", "group_name")
    assert rows(found) == [("m", "Time-of-Use", "Affluent"), ("n", "Standard", "Unclassified")]


def test_an_unreadable_time_is_not_the_earliest(spark):
    stamps = [("2013-01-01 xx", "99", "99"), ("2013-01-01 00:00:00", "8", "2"), ("2013-01-01 00:00:00", None, "2")]
    frame = spark.createDataFrame(stamps, "time string, temperatureMax string, temperatureMin string")
    assert silver.clean_weather(frame).first().temp_avg == 5.0


def test_correlation_without_variance_is_nan_and_does_not_fail(spark):
    schema = "temp_avg double, avg_kwh_per_home double"
    level = spark.createDataFrame([(25.5, 2.0), (25.5, 4.0), (None, 50.0), (7.0, None)], schema)
    assert math.isnan(dashboard.temperature_correlation(level).first().r)
    assert math.isnan(dashboard.temperature_correlation(level.limit(1)).first().r)
    assert dashboard.temperature_correlation(level.filter("temp_avg IS NULL")).first().r is None
