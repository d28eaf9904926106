"""Long readings to one wide row per meter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.calendar import SLOTS_PER_DAY

SLOT_COLUMNS = tuple(f"hh_{slot}" for slot in range(SLOTS_PER_DAY))


def average_by_slot(readings: DataFrame) -> DataFrame:
    """``meter_id, hh_0 .. hh_47``: average kWh of a meter in each slot, 0 where it has none.

    The slots are named, so no job looks for them. Spark aggregates by (meter, slot) first, which
    spreads a hot meter over 48 keys, and moves at most 48 values per meter for the second step.
    """
    wide = readings.groupBy("meter_id").pivot("half_hour", list(range(SLOTS_PER_DAY))).agg(F.avg("kwh"))
    return wide.select(
        "meter_id",
        *[F.coalesce(F.col(str(slot)), F.lit(0.0)).alias(f"hh_{slot}") for slot in range(SLOTS_PER_DAY)],
    )
