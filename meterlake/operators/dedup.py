"""One row per key, the same row on every run.

Both forms are aggregates, so copies of a key collapse inside each map task before the shuffle:
a key that holds a third of all rows costs one row per task on the wire.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def smallest_value(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys and their smallest value, for tables with one measure (hash aggregate)."""
    return rows.groupBy(*keys).agg(F.min(value).alias(value))


def smallest_row(rows: DataFrame, keys: Sequence[str], first_by: Sequence[str] = ()) -> DataFrame:
    """The whole smallest row per key: by ``first_by``, then by the other columns; in each, nulls last."""
    others = [c for c in rows.columns if c not in keys and c not in first_by]
    if not others and not first_by:
        return rows.distinct()
    return (
        rows.groupBy(*keys)
        .agg(F.min(F.struct(*[_nulls_last(c) for c in (*first_by, *others)])).alias("kept"))
        .select(*[c if c in keys else F.col(f"kept.{c}.value").alias(c) for c in rows.columns])
    )


def _nulls_last(column: str) -> Column:
    return F.struct(F.col(column).isNull().alias("missing"), F.col(column).alias("value")).alias(column)
