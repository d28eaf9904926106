"""Gold layer: the meter-day fact and the marts above it.

The fact has one row per (meter, day): the daily table has, and the dimensions are unique on their
keys. The marts rely on that grain where they count homes of a single day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions import calendar
from meterlake.functions.rounding import Totals, rounder

DAY_ATTRIBUTES = ("season", "is_weekend", "is_holiday")

# A cell of the group profile may hold a large share of all meter-days. The median's rank is off by
# at most this part of the cell; a sketch stays within a few MB per cell and task.
MEDIAN_ACCURACY = 100_000


def with_household(daily: DataFrame, households: DataFrame) -> DataFrame:
    """Tariff, group and category of each meter; null where the meter is not listed.

    No hint: the household list grows with the meters, so the planner chooses by size.
    """
    return daily.join(households.select("meter_id", "tariff", "group_name", "detail_code"), "meter_id", "left")


def with_calendar(rows: DataFrame, weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """Weather, holiday name and calendar columns of ``day``.

    Both dimensions have one row per calendar day; saved, their size is known and the planner broadcasts them.
    """
    joined = rows.join(weather, "day", "left").join(holidays.select("day", "holiday_name"), "day", "left")
    return with_day_attributes(joined)


def with_day_attributes(rows: DataFrame) -> DataFrame:
    return rows.select(
        "*",
        F.year("day").alias("year"),
        F.month("day").alias("month"),
        F.dayofweek("day").alias("day_of_week"),
        calendar.weekend_flag("day").alias("is_weekend"),
        F.col("holiday_name").isNotNull().cast("int").alias("is_holiday"),
        calendar.season("day").alias("season"),
    )


def household_days(
    daily: DataFrame, households: DataFrame, weather: DataFrame, holidays: DataFrame
) -> DataFrame:
    """The fact: daily consumption with tariff, group, weather and calendar."""
    measured = daily.withColumnRenamed("energy_sum", "daily_kwh")
    return with_calendar(with_household(measured, households), weather, holidays)


def daily_totals(fact: DataFrame, rounded: bool = True, exact: bool = False) -> DataFrame:
    """One row per day, from the fact. The day fixes its attributes and its temperature. For ``exact`` see ``Totals``."""
    return _by_day(fact, (*DAY_ATTRIBUTES,), F.max("temp_avg"), rounded, exact)


def daily_totals_unsaved(
    daily: DataFrame, weather: DataFrame, holidays: DataFrame, rounded: bool = True
) -> DataFrame:
    """The same totals where no fact is saved: sum by day first, then join day to day.

    No household and no meter-level row is joined; both join sides have one row per day.
    """
    r = rounder(rounded)
    by_day = _by_day(daily.withColumnRenamed("energy_sum", "daily_kwh"), (), None, rounded)
    joined = by_day.join(weather.select("day", "temp_avg"), "day", "left")
    joined = joined.join(holidays.select("day", "holiday_name"), "day", "left")
    return with_day_attributes(joined).select(
        "day", *DAY_ATTRIBUTES, "total_kwh", "avg_kwh_per_home", "active_homes",
        r(F.col("temp_avg"), 2).alias("temp_avg"),
    )


def _by_day(rows: DataFrame, attributes: tuple[str, ...], temperature, rounded: bool, exact: bool = False) -> DataFrame:
    r, total = rounder(rounded), Totals(exact, rounded)
    measures = [
        total.sum("daily_kwh", 1).alias("total_kwh"),
        total.avg("daily_kwh", 3).alias("avg_kwh_per_home"),
        # one row per (meter, day): counting rows with a meter counts distinct meters
        F.count("meter_id").alias("active_homes"),
    ]
    if temperature is not None:
        measures.append(r(temperature, 2).alias("temp_avg"))
    return rows.groupBy("day", *attributes).agg(*measures)


def group_consumption(fact: DataFrame, rounded: bool = True, exact: bool = False) -> DataFrame:
    """Average meter-day and distinct homes of each customer group and tariff."""
    return fact.groupBy("group_name", "tariff").agg(
        Totals(exact, rounded).avg("daily_kwh", 3).alias("avg_daily_kwh"),
        F.countDistinct("meter_id").alias("households"),
    )


def group_profile(fact: DataFrame, rounded: bool = True, exact: bool = False) -> DataFrame:
    """``group_consumption`` with the median meter-day.

    Two aggregates over the fact instead of one: a median beside a distinct count would be kept
    per meter and shuffled, alone it is a handful of sketches per task.
    """
    r = rounder(rounded)
    medians = fact.groupBy("group_name", "tariff").agg(
        r(F.percentile_approx("daily_kwh", 0.5, MEDIAN_ACCURACY), 3).alias("median_daily_kwh")
    )
    c, m = group_consumption(fact, rounded, exact).alias("c"), medians.alias("m")
    same_cell = F.col("c.group_name").eqNullSafe(F.col("m.group_name")) & F.col("c.tariff").eqNullSafe(
        F.col("m.tariff")
    )
    return c.join(m, same_cell).select(
        "c.group_name", "c.tariff", "c.avg_daily_kwh", "m.median_daily_kwh", "c.households"
    )


def group_homes(fact: DataFrame, meters: DataFrame) -> DataFrame:
    """Homes of each (group, tariff, category) as bitmaps of the meters' numbers, 32,768 numbers to a bitmap.

    Cells of bitmaps can be united, so distinct homes of any coarser cell follow from this table alone. Tasks keep
    one bitmap of 4 KB for a cell and bucket, however many meter-days fall into it.
    """
    number = F.col("meter_no")
    cell = ("group_name", "tariff", "detail_code", F.bitmap_bucket_number(number).alias("bucket"))
    return fact.join(meters, "meter_id").groupBy(*cell).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("homes"))


def load_profile(readings: DataFrame, rounded: bool = True, exact: bool = False) -> DataFrame:
    """Average demand in each of the 48 half-hours of a day."""
    averages = readings.groupBy("half_hour").agg(Totals(exact, rounded).avg("kwh", 5).alias("avg_kwh"))
    return averages.select("half_hour", calendar.clock_time("half_hour").alias("clock_time"), "avg_kwh")
