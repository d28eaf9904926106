"""Silver layer: clean, type and deduplicate; derive the daily table from the readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions import calendar, text
from meterlake.functions.rounding import Totals, rounder
from meterlake.operators.dedup import smallest_row, smallest_value
from meterlake.tables import WEATHER_MEASURES, WEATHER_TEXTS


def clean_readings(bronze: DataFrame, by_month: bool = False, months: Sequence[int] | None = None) -> DataFrame:
    """Typed readings, one per (meter, time); of several energies for one time the smallest stays.

    Rows whose time or energy cannot be read go, but only after the aggregate, which ignores them
    anyway: a filter below it would parse every cell a second time. Everything else about a reading
    follows from its key, so three columns are shuffled and the slots computed behind the shuffle.
    ``by_month`` lays the rows out for saving, with their month; ``months`` (202401 for January 2024) takes only those.
    """
    typed = bronze.select(
        F.col("LCLid").alias("meter_id"),
        text.timestamp("tstp").alias("read_at"),
        text.number("energy_kWh_hh").alias("kwh"),
    )
    if months is not None:
        typed = typed.filter(_year_month("read_at").isin(list(months)))
    unique = smallest_value(typed, ["meter_id", "read_at"], "kwh").na.drop(subset=["read_at", "kwh"])
    return with_slots(clustered_by_month(unique), "year_month") if by_month else with_slots(unique)


def _year_month(time: str) -> Column:
    return F.year(time) * 100 + F.month(time)


def clustered_by_month(readings: DataFrame) -> DataFrame:
    """Layout for the saved readings: months one after the other, in them whole meter-days, each meter in time order.

    Tasks take ranges of (month, meter, day), cut by a sample of the rows, so a task writes one file for most of its
    months and the files are about as many as tasks and months together. A later aggregate by (meter, day) collapses
    inside the scan tasks, so almost nothing of the large table is shuffled again. The order compares the hash of
    a meter, a number, instead of its text. For readings that are unique per second: a key can then hold 86,400 rows
    at most, which is why this shuffle cannot be skewed by one meter.
    """
    placed = readings.withColumn("year_month", _year_month("read_at"))
    meter = F.xxhash64("meter_id")
    return placed.repartitionByRange("year_month", meter, F.to_date("read_at")).sortWithinPartitions("year_month", meter, "read_at")


def with_slots(readings: DataFrame, *more: str) -> DataFrame:
    """``meter_id, read_at, kwh`` with day, hour and half-hour slot, and more columns as they are."""
    return readings.select(
        "meter_id",
        "read_at",
        F.to_date("read_at").alias("day"),
        F.hour("read_at").alias("hour"),
        calendar.half_hour("read_at").alias("half_hour"),
        "kwh",
        *more,
    )


def daily_statistics(readings: DataFrame, rounded: bool = True, exact: bool = False) -> DataFrame:
    """Statistics per meter and day; incomplete days stay and show in ``energy_count``. For ``exact`` see ``Totals``."""
    r, total = rounder(rounded), Totals(exact, rounded)
    return readings.groupBy("meter_id", "day").agg(
        total.sum("kwh", 4).alias("energy_sum"),
        total.avg("kwh", 5).alias("energy_mean"),
        F.percentile_approx("kwh", 0.5).alias("energy_median"),
        F.max("kwh").alias("energy_max"),
        F.min("kwh").alias("energy_min"),
        r(F.stddev_samp("kwh"), 5).alias("energy_std"),
        F.count("kwh").alias("energy_count"),
    )


def number_meters(daily: DataFrame, numbered: DataFrame | None = None, parts: int = 200) -> DataFrame:
    """``meter_id, meter_no``: numbers from 1 without gaps. Meters that have a number keep it, new ones follow the largest.

    Meters are ranked within parts by their hash, and a part begins where the parts before it end; so nothing
    is sorted as a whole, and the same meters get the same numbers in whatever tasks they are.
    """
    meters, known = daily.select("meter_id").distinct(), 0
    if numbered is not None:
        meters = meters.join(numbered, "meter_id", "left_anti")
        known = numbered.agg(F.max("meter_no")).first()[0] or 0
    placed = meters.withColumn("part", F.pmod(F.xxhash64("meter_id"), F.lit(parts)))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    # one row for each part
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    ranked = placed.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy("meter_id")))
    fresh = ranked.join(before, "part").select("meter_id", (F.col("before") + F.col("nth") + known).alias("meter_no"))
    return fresh if numbered is None else numbered.unionByName(fresh)


def clean_households(bronze: DataFrame) -> DataFrame:
    """Household dimension, one row per meter."""
    listed = bronze.select(
        F.col("LCLid").alias("meter_id"),
        F.col("stdorToU").alias("tariff_flag"),
        F.col("Acorn").alias("detail_code"),
        F.col("Acorn_grouped").alias("group_raw"),
    )
    return smallest_row(listed, ["meter_id"]).select(
        "meter_id",
        "tariff_flag",
        text.tariff_name("tariff_flag").alias("tariff"),
        "detail_code",
        "group_raw",
        text.group_name("group_raw").alias("group_name"),
    )


def clean_weather(bronze: DataFrame) -> DataFrame:
    """Weather dimension, one row per day: the earliest stamp of the day stays.

    Measures the file lacks become null columns; rows without a readable day go.
    """
    present = set(bronze.columns)
    measures = [
        (text.number(raw) if raw in present else F.lit(None).cast("double")).alias(name)
        for raw, name in WEATHER_MEASURES.items()
    ]
    texts = [
        (F.col(raw) if raw in present else F.lit(None).cast("string")).alias(name)
        for raw, name in WEATHER_TEXTS.items()
    ]
    stamped = bronze.select(
        text.date("time").alias("day"), text.timestamp("time").alias("stamp"), *measures, *texts
    ).na.drop(subset=["day"])
    return smallest_row(stamped, ["day"], first_by=["stamp"]).select(
        "day",
        ((F.col("temp_max") + F.col("temp_min")) / 2).alias("temp_avg"),
        *WEATHER_MEASURES.values(),
        *WEATHER_TEXTS.values(),
    )


def clean_holidays(bronze: DataFrame) -> DataFrame:
    """Bank-holiday dimension, one row per day; unreadable dates go."""
    dated = bronze.select(
        text.date("Bank_holidays").alias("day"), F.col("Type").alias("holiday_name")
    ).na.drop(subset=["day"])
    return smallest_row(dated, ["day"])
