"""Slots of the day and attributes of a calendar day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOTS_PER_DAY = 48

# The season of each month, January first.
SEASON_OF_MONTH = (
    "Winter", "Winter",
    "Spring", "Spring", "Spring",
    "Summer", "Summer", "Summer",
    "Autumn", "Autumn", "Autumn",
    "Winter",
)
SEASONS = tuple(sorted(set(SEASON_OF_MONTH)))


def half_hour(ts: str) -> Column:
    """Slot 0..47 that a time falls into; off-grid times are floored."""
    return (F.hour(ts) * 2 + (F.minute(ts) >= 30).cast("int")).cast("int")


def clock_time(slot: str) -> Column:
    """``HH:MM`` at which a slot starts."""
    return F.format_string("%02d:%02d", F.floor(F.col(slot) / 2), F.col(slot) % 2 * 30)


def season(day: str) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in SEASON_OF_MONTH]), F.month(day))


def season_index(name: str) -> Column:
    """Position of a season in alphabetical order, as a double for model features."""
    return (F.array_position(F.array(*[F.lit(s) for s in SEASONS]), F.col(name)) - 1).cast("double")


def weekend_flag(day: str) -> Column:
    return (F.weekday(day) >= 5).cast("int")
