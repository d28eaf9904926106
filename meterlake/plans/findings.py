"""Findings as one small query each: the peak window and the gaps between best and worst."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PEAK_SLOTS = 6  # three hours


def peak_slots(profile: DataFrame, slots: int = PEAK_SLOTS) -> DataFrame:
    """The slots with the highest average demand; equal slots in time order."""
    return (
        profile.select("half_hour", "clock_time", "avg_kwh")
        .orderBy(F.desc("avg_kwh"), "half_hour")
        .limit(slots)
    )


def gap(rows: DataFrame, name: str, kwh: str, digits: int = 3) -> DataFrame:
    """Highest against lowest row of a small result, and how far above it lies in percent; null above 0."""
    named = rows.filter(F.col(name).isNotNull() & F.col(kwh).isNotNull())
    ends = named.agg(
        F.max(F.struct(kwh, name)).alias("high"),
        F.min(F.struct(kwh, name)).alias("low"),
    )
    high, low = F.col(f"high.{kwh}"), F.col(f"low.{kwh}")
    return ends.select(
        F.col(f"high.{name}").alias("high_name"),
        F.round(high, digits).alias("high_kwh"),
        F.col(f"low.{name}").alias("low_name"),
        F.round(low, digits).alias("low_kwh"),
        F.round(F.try_divide(high - low, low) * 100, 1).alias("gap_pct"),
    )


def season_gap(effects: DataFrame, high: str = "Winter", low: str = "Summer") -> DataFrame:
    """Two named seasons side by side."""
    def of(season: str):
        return F.max(F.when(F.col("season") == season, F.col("avg_per_home")))

    ends = effects.agg(of(high).alias("h"), of(low).alias("l"))
    return ends.select(
        F.lit(high).alias("high_name"),
        F.round("h", 3).alias("high_kwh"),
        F.lit(low).alias("low_name"),
        F.round("l", 3).alias("low_kwh"),
        F.round(F.try_divide(F.col("h") - F.col("l"), F.col("l")) * 100, 1).alias("gap_pct"),
    )
