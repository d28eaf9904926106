"""Column expressions: reading text, slots, calendar, names."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from meterlake.functions import calendar, text

D = datetime.date
T = datetime.datetime


def column(spark, values, type_, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_}")
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def test_number_reads_padded_text_and_nothing_else(spark):
    cells = [" 0.25 ", "1e2", "-3", "Null", "", "  ", "NaN", "nan", "abc", None, "0"]
    assert column(spark, cells, "string", text.number("x")) == [
        0.25, 100.0, -3.0, None, None, None, None, None, None, None, 0.0,
    ]


def test_timestamp_drops_the_fraction_and_never_raises(spark):
    cells = ["2012-10-12 00:30:00.0000000", "2012-10-12 00:30:59.9999999", "bad", "", None, "2012-13-40 00:00:00"]
    assert column(spark, cells, "string", text.timestamp("x")) == [
        T(2012, 10, 12, 0, 30), T(2012, 10, 12, 0, 30, 59), None, None, None, None,
    ]


def test_date_reads_days_and_stamps(spark):
    cells = ["2012-12-26", "2012-12-26 10:00:00", "bad", "", None]
    assert column(spark, cells, "string", text.date("x")) == [D(2012, 12, 26), D(2012, 12, 26), None, None, None]


def test_tariff_name(spark):
    assert column(spark, ["ToU", "Std", None, "other"], "string", text.tariff_name("x")) == [
        "Time-of-Use", "Standard", "Standard", "Standard",
    ]


def test_blank_groups_are_unclassified(spark):
    cells = ["Affluent", "ACORN-", "ACORN-U", "", "  ", None]
    assert column(spark, cells, "string", text.group_name("x")) == ["Affluent"] + ["Unclassified"] * 5


@pytest.mark.parametrize(
    "name, safe",
    [
        ("energy(kWh/hh)", "energy_kWh_hh"),
        ("Bank holidays", "Bank_holidays"),
        ("_source_file", "_source_file"),
        ("a, ;{}b\n\t=c", "a_b_c"),
        ("plain", "plain"),
    ],
)
def test_safe_names(name, safe):
    assert text.safe_names([name]) == [safe]


def test_safe_names_refuse_collisions():
    with pytest.raises(ValueError, match="a_b"):
        text.safe_names(["a b", "a(b"])


def test_half_hour_floors_off_grid_times(spark):
    base = T(2013, 1, 1)
    minutes = [0, 29, 30, 59, 60, 913, 23 * 60 + 30, 24 * 60 - 1]
    stamps = [base + datetime.timedelta(minutes=m, seconds=38) for m in minutes]
    assert column(spark, stamps, "timestamp_ntz", calendar.half_hour("x")) == [m // 30 for m in minutes]


def test_clock_time_of_every_slot(spark):
    slots = list(range(48))
    assert column(spark, slots, "int", calendar.clock_time("x")) == [
        f"{s // 2:02d}:{'30' if s % 2 else '00'}" for s in slots
    ]


def test_season_and_its_index_for_every_month(spark):
    days = [D(2013, m, 15) for m in range(1, 13)]
    expected = ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]
    assert column(spark, days, "date", calendar.season("x")) == expected
    order = {"Autumn": 0.0, "Spring": 1.0, "Summer": 2.0, "Winter": 3.0}
    assert column(spark, expected, "string", calendar.season_index("x")) == [order[s] for s in expected]


def test_weekend_flag_over_a_week(spark):
    monday = D(2013, 4, 1)
    days = [monday + datetime.timedelta(days=i) for i in range(7)]
    assert column(spark, days, "date", calendar.weekend_flag("x")) == [0, 0, 0, 0, 0, 1, 1]
    # the two weekday codings: Sunday 1 in the fact, Monday 0 in the model
    assert column(spark, days, "date", F.dayofweek("x")) == [2, 3, 4, 5, 6, 7, 1]
    assert column(spark, days, "date", F.weekday("x")) == [0, 1, 2, 3, 4, 5, 6]
