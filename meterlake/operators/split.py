"""Split of a day-level table by time."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_training_day(days: DataFrame, share: float) -> datetime.date | None:
    """The day at rank ``int(share * n)`` of a table with one row per day; None if that rank is 0.

    Two small jobs over a table bounded by the calendar: callers pass a saved or scratch table.
    """
    rank = int(days.count() * share)
    if rank == 0:
        return None
    return days.select("day").orderBy("day").limit(rank).agg(F.max("day")).first()[0]


def training_flag(cutoff: datetime.date | None) -> Column:
    """True up to and including the cutoff day."""
    return F.lit(False) if cutoff is None else F.col("day") <= F.lit(cutoff)
