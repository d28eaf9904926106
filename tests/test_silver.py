"""Cleaning: one test per fault the raw sources have."""

from __future__ import annotations

import datetime
import statistics
from collections import defaultdict

from frames import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meterlake.operators.dedup import smallest_row, smallest_value
from meterlake.plans import silver

D, T = datetime.date, datetime.datetime
READINGS = "LCLid string, tstp string, energy_kWh_hh string"


def test_clean_readings(spark):
    raw = spark.createDataFrame(
        [
            ("A", "2013-01-01 00:00:00.0000000", " 0.5 "),
            ("A", "2013-01-01 00:30:00.0000000", "Null"),
            ("A", "2013-01-01 01:00:00.0000000", ""),
            ("A", "2013-01-01 01:30:00.0000000", "NaN"),
            ("A", "bad", "0.1"),
            ("A", "2013-01-01 15:13:38.0000000", "0.2"),  # off the grid
            ("A", "2013-01-01 23:30:00.0000000", "0.3"),
            ("A", "2013-01-01 23:30:00.0000000", "0.3"),  # exact copy
            ("B", "2013-01-01 00:00:00.0000000", "0.9"),
            ("B", "2013-01-01 00:00:00.5000000", "0.4"),  # the same second, another energy
        ],
        READINGS,
    )
    assert rows(silver.clean_readings(raw)) == [
        ("A", T(2013, 1, 1, 0, 0), D(2013, 1, 1), 0, 0, 0.5),
        ("A", T(2013, 1, 1, 15, 13, 38), D(2013, 1, 1), 15, 30, 0.2),
        ("A", T(2013, 1, 1, 23, 30), D(2013, 1, 1), 23, 47, 0.3),
        ("B", T(2013, 1, 1, 0, 0), D(2013, 1, 1), 0, 0, 0.4),
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("ABC"), st.integers(0, 5), st.integers(-9, 9).map(float)), min_size=1, max_size=60
    )
)
def test_dedup_against_brute_force(spark, data):
    frame = spark.createDataFrame(data, "m string, s int, v double").repartition(3)
    smallest: dict = {}
    for m, s, v in data:
        smallest[m, s] = min(v, smallest.get((m, s), v))
    expected = sorted((m, s, v) for (m, s), v in smallest.items())
    assert rows(smallest_value(frame, ["m", "s"], "v")) == expected
    assert rows(smallest_row(frame, ["m", "s"])) == expected


def test_smallest_row_prefers_given_columns_and_values_over_nulls(spark):
    frame = spark.createDataFrame(
        [("k", 2, "a", None), ("k", 1, "z", 5), ("k", 1, "z", None), ("l", 1, None, 1)],
        "key string, first int, other string, number int",
    )
    assert rows(smallest_row(frame, ["key"], first_by=["first"])) == [("k", 1, "z", 5), ("l", 1, None, 1)]


def test_daily_statistics_against_python(spark):
    import random

    random.seed(7)
    data = [
        (m, T(2013, 1, 1 + d, h, 30 * half), D(2013, 1, 1 + d), h, h * 2 + half, random.randrange(1, 4000) / 1000)
        for m in "ABCD" for d in range(3) for h in range(24) for half in (0, 1) if random.random() < 0.8
    ] + [("E", T(2013, 1, 9), D(2013, 1, 9), 0, 0, 1.25)]
    frame = spark.createDataFrame(
        data, "meter_id string, read_at timestamp_ntz, day date, hour int, half_hour int, kwh double"
    )
    groups = defaultdict(list)
    for m, _, day, _, _, kwh in data:
        groups[m, day].append(kwh)
    found = {(r.meter_id, r.day): r for r in silver.daily_statistics(frame, rounded=False).collect()}
    assert found.keys() == groups.keys()
    for key, values in groups.items():
        r = found[key]
        assert abs(r.energy_sum - sum(values)) < 1e-9
        assert abs(r.energy_mean - statistics.fmean(values)) < 1e-9
        assert r.energy_median == statistics.median_low(values)
        assert (r.energy_max, r.energy_min, r.energy_count) == (max(values), min(values), len(values))
        if len(values) > 1:
            assert abs(r.energy_std - statistics.stdev(values)) < 1e-9
        else:
            assert r.energy_std is None
    rounded = {(r.meter_id, r.day): r for r in silver.daily_statistics(frame).collect()}
    for key, r in rounded.items():
        assert abs(r.energy_sum - found[key].energy_sum) <= 5e-5 + 1e-12
        assert abs(r.energy_mean - found[key].energy_mean) <= 5e-6 + 1e-12


def test_clustering_keeps_rows_and_puts_a_meter_day_into_one_partition(spark):
    from pyspark.sql import functions as F

    raw = spark.createDataFrame(
        [(f"M{i % 7}", f"2013-01-{1 + i % 5:02d} {i % 24:02d}:00:00", f" {i} ") for i in range(400)], READINGS
    )
    laid = silver.clean_readings(raw, by_month=True)
    assert rows(laid.drop("year_month")) == rows(silver.clean_readings(raw))
    assert rows(laid.select("year_month").distinct()) == [(201301,)]
    spread = laid.withColumn("p", F.spark_partition_id()).groupBy("meter_id", "day").agg(F.countDistinct("p").alias("n"))
    assert spread.agg(F.max("n")).first()[0] == 1


def test_clean_households(spark):
    raw = spark.createDataFrame(
        [
            ("A", "ToU", "ACORN-A", "Affluent", "block_0"),
            ("B", "Std", "ACORN-U", "ACORN-U", "block_0"),
            ("C", None, "ACORN-", None, "block_1"),
            ("D", "Std", None, "", "block_1"),
            ("A", "ToU", "ACORN-A", "Affluent", "block_9"),
        ],
        "LCLid string, stdorToU string, Acorn string, Acorn_grouped string, file string",
    )
    cleaned = silver.clean_households(raw)
    assert rows(cleaned, "meter_id", "tariff", "detail_code", "group_name") == [
        ("A", "Time-of-Use", "ACORN-A", "Affluent"),
        ("B", "Standard", "ACORN-U", "Unclassified"),
        ("C", "Standard", "ACORN-", "Unclassified"),
        ("D", "Standard", None, "Unclassified"),
    ]
    assert {r.meter_id: r.group_raw for r in cleaned.collect()} == {
        "A": "Affluent", "B": "ACORN-U", "C": None, "D": "",
    }


def test_clean_weather(spark):
    raw = spark.createDataFrame(
        [
            ("2013-01-02 00:00:00", "9", "1", "0.8", "rain"),
            ("2013-01-01 12:00:00", "90", "10", "0.1", "late"),
            ("2013-01-01 00:00:00", "8.5", "1.5", "x", "early"),
            ("2013-01-03 00:00:00", "7", "Null", "0.5", "half"),
            ("no day", "7", "7", "0.5", "lost"),
        ],
        "time string, temperatureMax string, temperatureMin string, humidity string, summary string",
    )
    weather = silver.clean_weather(raw)
    assert weather.columns == [
        "day", "temp_avg", "temp_max", "temp_min", "humidity", "wind_speed", "cloud_cover", "pressure",
        "uv_index", "precip_type", "summary",
    ]
    assert rows(weather, "day", "temp_avg", "temp_max", "temp_min", "humidity", "pressure", "summary") == [
        (D(2013, 1, 1), 5.0, 8.5, 1.5, None, None, "early"),
        (D(2013, 1, 2), 5.0, 9.0, 1.0, 0.8, None, "rain"),
        (D(2013, 1, 3), None, 7.0, None, 0.5, None, "half"),
    ]


def test_clean_holidays(spark):
    raw = spark.createDataFrame(
        [("2012-12-26", "Boxing Day"), ("2012-12-25", "Christmas Day"), ("2012-12-26", "Boxing Day again"), ("?", "x")],
        "Bank_holidays string, Type string",
    )
    assert rows(silver.clean_holidays(raw)) == [
        (D(2012, 12, 25), "Christmas Day"), (D(2012, 12, 26), "Boxing Day"),
    ]


def test_clean_readings_of_some_months(spark):
    raw = spark.createDataFrame(
        [("A", f"2013-{m:02d}-0{d} 00:00:00", str(m)) for m in range(1, 13) for d in (1, 2)] + [("A", "2014-02-01 00:00:00", "9")], READINGS
    )
    some = silver.clean_readings(raw, months=[201302, 201311])
    assert rows(some, "kwh") == [(2.0,), (2.0,), (11.0,), (11.0,)] or sorted(r.kwh for r in some.collect()) == [2.0, 2.0, 11.0, 11.0]


def test_meters_keep_their_numbers(spark):
    def daily(*names):
        return spark.createDataFrame([(n, d) for n in names for d in (1, 2, 3)], "meter_id string, day int").repartition(3)

    first = silver.number_meters(daily(*[f"M{k}" for k in range(40)]), parts=7)
    numbers = {r.meter_id: r.meter_no for r in first.collect()}
    assert sorted(numbers.values()) == list(range(1, 41))
    assert numbers == {r.meter_id: r.meter_no for r in silver.number_meters(daily(*reversed(list(numbers))).repartition(9), parts=7).collect()}
    later = silver.number_meters(daily("M3", "new", "newer"), first, parts=7)
    grown = {r.meter_id: r.meter_no for r in later.collect()}
    assert {k: grown[k] for k in numbers} == numbers and sorted(grown[k] for k in ("new", "newer")) == [41, 42]
    assert silver.number_meters(daily("x").limit(0), parts=7).count() == 0


def test_exact_sums_round_halves_up_in_any_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9, 0.00005, 1e-7, 2.5]
    schema = "meter_id string, day int, kwh double"
    forward = spark.createDataFrame([("A", 1, v) for v in values], schema).coalesce(1)
    backward = spark.createDataFrame([("A", 1, v) for v in reversed(values)], schema).repartition(5)
    found = [silver.daily_statistics(f, exact=True).select("energy_sum", "energy_mean").first() for f in (forward, backward)]
    assert found[0] == found[1] == (3.1001, 0.38751)
    ties = spark.createDataFrame([("A", 1, 1.00005), ("B", 1, 0.00015), ("B", 1, 0.0002), ("C", 1, None)], schema)
    assert rows(silver.daily_statistics(ties, exact=True), "meter_id", "energy_sum", "energy_mean") == [
        ("A", 1.0001, 1.00005), ("B", 0.0004, 0.00018), ("C", None, None),
    ]


def test_no_layout_of_the_exact_sums_is_one_task(spark, sf_dir, monkeypatch):
    from meterlake.harness import queries

    dealt, statistics = [], silver.daily_statistics

    def noted(rows, **options):
        dealt.append(rows.rdd.getNumPartitions())
        return statistics(rows, **options)

    monkeypatch.setattr(queries.silver, "daily_statistics", noted)
    found = queries.silver_daily_exact(spark, sf_dir)
    assert len(set(dealt)) == 5 and min(dealt) >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert found.filter("n_values <> 1 OR n_layouts <> 5").count() == 0
