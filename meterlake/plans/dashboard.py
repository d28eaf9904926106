"""Dashboard tiles and insights over the gold tables.

Each function takes the gold table it reads. ``digits`` are the published ones; None leaves a value
unrounded. Sorting is part of a tile, since its rows are shown in that order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.text import UNCLASSIFIED

MIN_HOMES = 5  # smaller categories are not shown


def _round(column: Column, digits: int | None) -> Column:
    return column if digits is None else F.round(column, digits)


def kpis(totals: DataFrame) -> DataFrame:
    return totals.agg(
        F.round(F.sum("total_kwh") / 1e6, 2).alias("total_gwh"),
        F.round(F.avg("avg_kwh_per_home"), 2).alias("avg_kwh_per_home_per_day"),
        F.max("active_homes").alias("peak_active_homes"),
        F.count("*").alias("days_covered"),
    )


def demand_trend(totals: DataFrame) -> DataFrame:
    return totals.select("day", "avg_kwh_per_home", "total_kwh", "active_homes").orderBy("day")


def _by_category(fact: DataFrame, kwh: str, digits: int | None) -> DataFrame:
    """Average and distinct homes per detailed category, categories of ``MIN_HOMES`` and more."""
    return (
        fact.groupBy("detail_code")
        .agg(
            _round(F.avg("daily_kwh"), digits).alias(kwh),
            F.countDistinct("meter_id").alias("homes"),
        )
        .filter(F.col("homes") >= MIN_HOMES)
    )


def detail_categories(fact: DataFrame, digits: int | None = 3) -> DataFrame:
    """Known categories, highest consumption first."""
    known = fact.filter(F.col("detail_code").isNotNull())
    return _by_category(known, "avg_daily_kwh", digits).orderBy(F.desc("avg_daily_kwh"), "detail_code")


def detail_categories_with_unknown(fact: DataFrame, digits: int | None = None) -> DataFrame:
    """All categories with the unknown one, lowest consumption first."""
    return _by_category(fact, "kwh", digits).orderBy("kwh", "detail_code")


def group_ranking(profile: DataFrame) -> DataFrame:
    """Classified customer groups; each tariff cell of a group counts once in its average."""
    return (
        profile.filter(F.col("group_name") != UNCLASSIFIED)
        .groupBy("group_name")
        .agg(
            F.round(F.avg("avg_daily_kwh"), 3).alias("avg_daily_kwh"),
            F.sum("households").alias("homes"),
        )
        .orderBy(F.desc("avg_daily_kwh"), "group_name")
    )


def tariff_comparison(profile: DataFrame, digits: int | None = 3) -> DataFrame:
    """Tariffs as the unweighted mean of their group cells."""
    return (
        profile.groupBy("tariff")
        .agg(
            _round(F.avg("avg_daily_kwh"), digits).alias("avg_daily_kwh"),
            F.sum("households").alias("households"),
        )
        .orderBy(F.desc("avg_daily_kwh"), "tariff")
    )


def distinct_homes(homes: DataFrame, *by: str) -> DataFrame:
    """Homes per cell of ``by``, exactly, from the bitmaps of finer cells: a home in several of them counts once."""
    united = homes.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("homes")).alias("homes"))
    return united.groupBy(*by).agg(F.sum("homes").alias("homes"))


def tariff_comparison_weighted(fact: DataFrame) -> DataFrame:
    """Tariffs as the mean over all their meter-days."""
    return (
        fact.groupBy("tariff")
        .agg(
            F.round(F.avg("daily_kwh"), 3).alias("avg_daily_kwh"),
            F.countDistinct("meter_id").alias("households"),
        )
        .orderBy(F.desc("avg_daily_kwh"), "tariff")
    )


def demand_against_temperature(totals: DataFrame) -> DataFrame:
    """Days with a known temperature, with their season."""
    return totals.filter(F.col("temp_avg").isNotNull()).select("temp_avg", "avg_kwh_per_home", "season")


def temperature_scatter(totals: DataFrame) -> DataFrame:
    """Pairs of which neither value is missing."""
    return totals.select("temp_avg", "avg_kwh_per_home").na.drop()


def temperature_correlation(totals: DataFrame) -> DataFrame:
    """Pearson correlation over the days that have both values; NaN where one of the two never varies, null without days.

    ``corr`` fails under ANSI rules where the spread is 0, so it is spelled as covariance over spread.
    """
    x, y = F.col("temp_avg"), F.col("avg_kwh_per_home")
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    r = F.coalesce(F.try_divide(F.covar_pop(x, y), spread), F.when(spread == 0, F.lit(float("nan"))))
    return totals.agg(F.round(r, 6).alias("r"))


def season_effects(totals: DataFrame, digits: int | None = 3) -> DataFrame:
    """Average per season, and over its weekend, week and holiday days."""
    def average(condition: Column | None = None) -> Column:
        value = F.col("avg_kwh_per_home")
        return _round(F.avg(value if condition is None else F.when(condition, value)), digits)

    return (
        totals.groupBy("season")
        .agg(
            average().alias("avg_per_home"),
            average(F.col("is_weekend") == 1).alias("weekend"),
            average(F.col("is_weekend") == 0).alias("weekday"),
            average(F.col("is_holiday") == 1).alias("holiday"),
        )
        .orderBy(F.desc("avg_per_home"), "season")
    )


def load_curve(profile: DataFrame) -> DataFrame:
    return profile.select("half_hour", "clock_time", "avg_kwh").orderBy("half_hour")


def segment_sizes(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count("*").alias("households")).orderBy("segment")


def segment_totals(daily: DataFrame, segments: DataFrame) -> DataFrame:
    """Homes, kWh and meter-days of each segment; summed per meter before the join."""
    per_meter = daily.groupBy("meter_id").agg(
        F.sum("energy_sum").alias("kwh"), F.count("energy_sum").alias("days")
    )
    return (
        per_meter.join(segments, "meter_id")
        .groupBy("segment")
        .agg(F.count("*").alias("households"), F.sum("kwh").alias("kwh"), F.sum("days").alias("days"))
    )


def segment_consumption(daily: DataFrame, segments: DataFrame) -> DataFrame:
    """Homes and average daily consumption of each segment (star relation on the meter).

    Meter-days are summed per meter before the join, so it moves one row per meter.
    """
    average = F.round(F.try_divide("kwh", "days"), 3).alias("avg_daily_kwh")
    return segment_totals(daily, segments).select("segment", "households", average).orderBy("segment")


def top_households(fact: DataFrame, k: int = 15, digits: int | None = 2) -> DataFrame:
    """The k meters with the highest average day; equal averages in meter order.

    A meter with several tariffs or categories shows the greatest.
    """
    return (
        fact.groupBy("meter_id")
        .agg(
            _round(F.avg("daily_kwh"), digits).alias("avg_daily_kwh"),
            F.max("tariff").alias("tariff"),
            F.max("detail_code").alias("detail_code"),
        )
        .select("meter_id", "avg_daily_kwh", "tariff", "detail_code")
        .orderBy(F.desc("avg_daily_kwh"), "meter_id")
        .limit(k)
    )
