"""Typing of raw text cells. Nothing here raises on bad input: a cell that cannot be read is null."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source format.
TIMESTAMP_TEXT_LENGTH = 19  # yyyy-MM-dd HH:mm:ss; a fraction behind it is dropped
DYNAMIC_TARIFF_FLAG = "ToU"
DYNAMIC_TARIFF = "Time-of-Use"
FLAT_TARIFF = "Standard"
UNCLASSIFIED = "Unclassified"
BLANK_GROUP_CODES = ("", "ACORN-", "ACORN-U")
FORBIDDEN_IN_NAMES = " ,;{}()\n\t=/"


def number(text: str | Column) -> Column:
    """The number in a text cell; ``Null``, blanks, words and NaN give null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.nullif(F.trim(column).try_cast("double"), F.lit(float("nan")))


def timestamp(text: str) -> Column:
    """The wall-clock time in a text cell, to the second."""
    return F.substring(text, 1, TIMESTAMP_TEXT_LENGTH).try_cast("timestamp_ntz")


def date(text: str) -> Column:
    """The calendar day in a text cell that starts with one."""
    return F.col(text).try_cast("date")


def tariff_name(flag: str) -> Column:
    """Every flag but the dynamic one, including a missing flag, is the flat tariff."""
    return F.when(F.col(flag) == DYNAMIC_TARIFF_FLAG, DYNAMIC_TARIFF).otherwise(FLAT_TARIFF)


def group_name(raw: str) -> Column:
    """The customer group, with a missing, empty or placeholder group made explicit."""
    trimmed = F.coalesce(F.trim(raw), F.lit(""))
    return F.when(trimmed.isin(*BLANK_GROUP_CODES), UNCLASSIFIED).otherwise(trimmed)


def safe_names(names: list[str]) -> list[str]:
    """Column names a table format accepts; two names that become one are an error."""
    forbidden_run = re.compile(f"[{re.escape(FORBIDDEN_IN_NAMES)}]+")
    safe = [forbidden_run.sub("_", name).rstrip("_") for name in names]
    clashes = sorted({name for name in safe if safe.count(name) > 1})
    if clashes:
        raise ValueError(f"column names collide after cleaning: {clashes} (from {names})")
    return safe
