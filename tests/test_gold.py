"""Star schema, marts and the queries over them."""

from __future__ import annotations

import datetime

import pytest
from frames import rows
from pyspark.sql import functions as F

from meterlake.harness import inputs
from meterlake.sources.scratch import materialize
from meterlake.plans import dashboard, findings, gold

D = datetime.date
DAILY = "meter_id string, day date, energy_sum double"
WEATHER = "day date, temp_avg double"
HOLIDAYS = "day date, holiday_name string"
HOUSEHOLDS = "meter_id string, tariff string, group_name string, detail_code string"


@pytest.fixture(scope="module")
def star(spark):
    daily = spark.createDataFrame(
        [
            ("A", D(2013, 1, 1), 4.0), ("B", D(2013, 1, 1), 8.0),
            ("A", D(2013, 7, 6), 2.0), ("B", D(2013, 7, 6), 3.0), ("Z", D(2013, 7, 6), 1.0),
            ("A", D(2013, 10, 7), 6.0),
        ],
        DAILY,
    )
    households = spark.createDataFrame(
        [("A", "Standard", "Affluent", "ACORN-A"), ("B", "Time-of-Use", "Unclassified", None),
         ("C", "Standard", "Affluent", "ACORN-B")],
        HOUSEHOLDS,
    )
    weather = spark.createDataFrame([(D(2013, 1, 1), 3.0), (D(2013, 7, 6), 21.5), (D(2013, 8, 1), 9.0)], WEATHER)
    holidays = spark.createDataFrame([(D(2013, 1, 1), "New Year")], HOLIDAYS)
    return daily, households, weather, holidays


def test_fact_keeps_every_meter_day_once(star):
    daily = star[0]
    fact = gold.household_days(*star)
    assert rows(fact, "meter_id", "day", "daily_kwh") == rows(daily)
    found = {(r.meter_id, r.day): r for r in fact.collect()}
    first, summer, last = found["A", D(2013, 1, 1)], found["Z", D(2013, 7, 6)], found["A", D(2013, 10, 7)]
    assert (first.tariff, first.is_holiday, first.holiday_name, first.season) == ("Standard", 1, "New Year", "Winter")
    assert (summer.tariff, summer.group_name, summer.is_weekend, summer.day_of_week) == (None, None, 1, 7)
    assert (summer.temp_avg, summer.season, summer.month, summer.year) == (21.5, "Summer", 7, 2013)
    assert (last.temp_avg, last.is_holiday, last.season, last.is_weekend) == (None, 0, "Autumn", 0)


def test_totals_agree_on_both_ways(star):
    daily, households, weather, holidays = star
    from_fact = gold.daily_totals(gold.household_days(*star))
    unsaved = gold.daily_totals_unsaved(daily, weather, holidays)
    columns = sorted(from_fact.columns)
    assert rows(from_fact, *columns) == rows(unsaved, *columns)
    assert rows(unsaved, "day", "total_kwh", "avg_kwh_per_home", "active_homes", "temp_avg") == [
        (D(2013, 1, 1), 12.0, 6.0, 2, 3.0), (D(2013, 10, 7), 6.0, 6.0, 1, None), (D(2013, 7, 6), 6.0, 2.0, 3, 21.5),
    ]


def test_totals_agree_on_the_test_tables(spark, sf_dir):
    star = inputs.star(spark, sf_dir)
    from_fact = gold.daily_totals(star.fact())
    columns = sorted(from_fact.columns)
    assert rows(from_fact, *columns) == rows(star.totals(rounded=True), *columns)


def test_group_profile_counts_distinct_homes_and_keeps_unknown_cells(star):
    assert rows(gold.group_profile(gold.household_days(*star))) == sorted([
        ("Affluent", "Standard", 4.0, 4.0, 1), ("Unclassified", "Time-of-Use", 5.5, 3.0, 1), (None, None, 1.0, 1.0, 1),
    ], key=repr)


def test_dimensions_are_broadcast_and_nothing_runs_while_planning(spark, star):
    daily, _, weather, holidays = star
    weather, holidays = materialize(weather, "test-weather"), materialize(holidays, "test-holidays")
    spark.sparkContext.setJobGroup("planning", "planning")
    joined = gold.with_calendar(daily, weather, holidays)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == 0
    assert joined._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 2


def test_load_profile_has_one_row_per_slot(spark, sf_dir):
    profile = gold.load_profile(inputs.readings(spark, sf_dir)).collect()
    assert sorted(r.half_hour for r in profile) == list(range(48))


def test_group_ranking_leaves_out_unclassified_and_unknown(star):
    profile = gold.group_profile(gold.household_days(*star))
    assert rows(dashboard.group_ranking(profile)) == [("Affluent", 4.0, 1)]


def test_categories_need_five_homes(spark):
    data = [(f"m{i}", "big", 10.0) for i in range(5)] + [(f"n{i}", "small", 1.0) for i in range(4)]
    data += [(f"o{i}", None, 2.0) for i in range(6)] + [("m0", "big", 40.0)]
    fact = spark.createDataFrame(data, "meter_id string, detail_code string, daily_kwh double")
    assert rows(dashboard.detail_categories(fact)) == [("big", 15.0, 5)]
    assert [tuple(r) for r in dashboard.detail_categories_with_unknown(fact).collect()] == [
        (None, 2.0, 6), ("big", 15.0, 5),
    ]


def test_tariffs_weighted_and_unweighted_differ(spark):
    profile = spark.createDataFrame(
        [("a", "Standard", 10.0, 1.0, 1), ("b", "Standard", 20.0, 1.0, 9)],
        "group_name string, tariff string, avg_daily_kwh double, median_daily_kwh double, households long",
    )
    assert rows(dashboard.tariff_comparison(profile)) == [("Standard", 15.0, 10)]
    fact = spark.createDataFrame(
        [("x", "Standard", 10.0)] + [(f"y{i}", "Standard", 20.0) for i in range(9)],
        "meter_id string, tariff string, daily_kwh double",
    )
    assert rows(dashboard.tariff_comparison_weighted(fact)) == [("Standard", 19.0, 10)]


def test_correlation_ignores_days_without_weather(spark):
    totals = spark.createDataFrame(
        [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 50.0)], "temp_avg double, avg_kwh_per_home double"
    )
    assert dashboard.temperature_correlation(totals).first().r == 1.0
    assert dashboard.temperature_scatter(totals).count() == 3


def test_season_effects(spark):
    totals = spark.createDataFrame(
        [("Winter", 1, 0, 10.0), ("Winter", 0, 1, 20.0), ("Summer", 0, 0, 5.0)],
        "season string, is_weekend int, is_holiday int, avg_kwh_per_home double",
    )
    assert [tuple(r) for r in dashboard.season_effects(totals).collect()] == [
        ("Winter", 15.0, 10.0, 20.0, 20.0), ("Summer", 5.0, None, 5.0, None),
    ]
    gap = findings.season_gap(dashboard.season_effects(totals)).first()
    assert tuple(gap) == ("Winter", 15.0, "Summer", 5.0, 200.0)


def test_kpis(star):
    daily, _, weather, holidays = star
    kpis = dashboard.kpis(gold.daily_totals_unsaved(daily, weather, holidays)).first()
    assert tuple(kpis) == (0.0, 4.67, 3, 3)


def test_top_households_break_ties_by_meter(spark):
    data = [(f"m{i:02d}", "Standard", "c", 1.0 + i // 4) for i in range(40)]
    fact = spark.createDataFrame(data, "meter_id string, tariff string, detail_code string, daily_kwh double")
    top = [(r.meter_id, r.avg_daily_kwh) for r in dashboard.top_households(fact).collect()]
    assert top == sorted(((m, v) for m, _, _, v in data), key=lambda p: (-p[1], p[0]))[:15]


def test_peak_slots_and_gap(spark):
    profile = spark.createDataFrame(
        [(i, f"{i // 2:02d}:00", float(i % 10)) for i in range(48)], "half_hour int, clock_time string, avg_kwh double"
    )
    assert [r.half_hour for r in findings.peak_slots(profile).collect()] == [9, 19, 29, 39, 8, 18]
    ranked = spark.createDataFrame([("a", 1.0), ("b", 1.8), (None, 9.0)], "name string, kwh double")
    assert tuple(findings.gap(ranked, "name", "kwh").first()) == ("b", 1.8, "a", 1.0, 80.0)


def test_totals_add_up_to_the_fact(spark, sf_dir):
    daily = inputs.daily(spark, sf_dir)
    total = daily.agg(F.sum("energy_sum")).first()[0]
    summed = inputs.totals(spark, sf_dir, rounded=False).agg(F.sum("total_kwh"), F.sum("active_homes")).first()
    assert summed[0] == pytest.approx(total)
    assert summed[1] == daily.count()
