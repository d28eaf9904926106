"""Rounding that can be switched off, and sums that do not depend on the order of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits of an energy that exact sums keep; readings have three or fewer, daily sums four.
ENERGY_DIGITS = 6


def rounder(rounded: bool):
    """``F.round`` when results are stored rounded, the value itself when a later step rounds."""
    def apply(column: Column, digits: int) -> Column:
        return F.round(column, digits) if rounded else column
    return apply


@dataclass(frozen=True)
class Totals:
    """Sum and average of a column of energies.

    ``exact`` adds decimals of ``ENERGY_DIGITS`` digits, so that the result and its rounding are the same in whatever order
    the tasks finish, and half ties always round up; otherwise doubles are added as they come. A value of 10**12 or more
    fits no such decimal and is left out of exact results.
    """

    exact: bool
    rounded: bool = True

    def _sum(self, column: str) -> Column:
        return F.sum(F.col(column).try_cast(f"decimal(18,{ENERGY_DIGITS})"))

    def sum(self, column: str, digits: int) -> Column:
        total = rounder(self.rounded)(self._sum(column) if self.exact else F.sum(column), digits)
        return total.cast("double")

    def avg(self, column: str, digits: int) -> Column:
        """The quotient of two decimals has at least ten more digits than are rounded to."""
        mean = F.try_divide(self._sum(column), F.count(column).cast("decimal(12,0)")) if self.exact else F.avg(column)
        return rounder(self.rounded)(mean, digits).cast("double")
