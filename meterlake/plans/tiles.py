"""The dashboard's tiles as lasting views over the saved gold tables, for tools that read SQL and run no Python.

A tile is described once, by its table, the columns it shows and the measures it takes over them, and spelled as SQL from
that. It shows what the function of the same tile in ``dashboard`` shows; averages over stored energies add decimals, so
that a tile has the same digits whatever the order of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from meterlake.plans.dashboard import MIN_HOMES
from meterlake.sources.lake import Lake


def mean(energy: str, digits: int, of: str = "") -> str:
    """Average of a stored energy, of all rows or of those that fulfil a condition."""
    kept = f" FILTER (WHERE {of})" if of else ""
    return f"CAST(round(avg(CAST({energy} AS DECIMAL(18, 4))){kept}, {digits}) AS DOUBLE)"


@dataclass(frozen=True)
class Tile:
    """``shown`` columns of a gold table; with ``measures`` (name -> aggregate) one row for each of their values."""

    comment: str
    table: str
    shown: tuple[str, ...] = ()
    measures: dict[str, str] = field(default_factory=dict)
    rows: str = ""
    groups: str = ""
    order: tuple[str, ...] = ()
    first: int | None = None

    def sql(self) -> str:
        columns = [*self.shown, *[f"{value} AS {name}" for name, value in self.measures.items()]]
        clauses = {
            "WHERE": self.rows, "GROUP BY": ", ".join(self.shown) if self.measures else "", "HAVING": self.groups,
            "ORDER BY": ", ".join(self.order), "LIMIT": str(self.first or ""),
        }
        return " ".join([f"SELECT {', '.join(columns)} FROM {{{self.table}}}", *[f"{k} {v}" for k, v in clauses.items() if v]])


_HOME = "avg_kwh_per_home"

TILES = {
    "tile_1_kpi": Tile(
        "Energy, average home, most homes on a day, days", "daily_totals",
        measures={
            "total_gwh": "round(sum(total_kwh) / 1e6, 2)", "avg_kwh_per_home_per_day": mean(_HOME, 2),
            "peak_active_homes": "max(active_homes)", "days_covered": "count(*)",
        },
    ),
    "tile_2_trend": Tile("Demand by day", "daily_totals", ("day", _HOME, "total_kwh", "active_homes"), order=("day",)),
    "tile_3_detail_category": Tile(
        f"Average day of each known category of {MIN_HOMES} homes or more, highest first", "household_day", ("detail_code",),
        {"avg_daily_kwh": mean("daily_kwh", 3), "homes": "count(DISTINCT meter_id)"},
        rows="detail_code IS NOT NULL", groups=f"homes >= {MIN_HOMES}", order=("avg_daily_kwh DESC", "detail_code"),
    ),
    "tile_4_tariff": Tile(
        "Tariffs as the mean of their group cells", "group_profile", ("tariff",),
        {"avg_daily_kwh": mean("avg_daily_kwh", 3), "households": "sum(households)"}, order=("avg_daily_kwh DESC", "tariff"),
    ),
    "tile_5_demand_vs_temp": Tile(
        "Demand and temperature of the days that have both", "daily_totals", ("temp_avg", _HOME, "season"), rows="temp_avg IS NOT NULL"
    ),
    "tile_6_season_effects": Tile(
        "Average home by season, and on its weekends, weekdays and holidays", "daily_totals", ("season",),
        {"avg_per_home": mean(_HOME, 3)}
        | {name: mean(_HOME, 3, of=days) for name, days in (("weekend", "is_weekend = 1"), ("weekday", "is_weekend = 0"), ("holiday", "is_holiday = 1"))},
        order=("avg_per_home DESC", "season"),
    ),
    "tile_7_load_curve": Tile("Average demand by half hour", "load_profile", ("half_hour", "clock_time", "avg_kwh"), order=("half_hour",)),
    "tile_8_segments": Tile("Homes in each behavioural segment", "segments", ("segment",), {"households": "count(*)"}, order=("segment",)),
    "tile_9_top_households": Tile(
        "The fifteen homes with the highest average day", "household_day", ("meter_id",),
        {"avg_daily_kwh": mean("daily_kwh", 2), "tariff": "max(tariff)", "detail_code": "max(detail_code)"},
        order=("avg_daily_kwh DESC", "meter_id"), first=15,
    ),
}


def define(lake: Lake) -> None:
    """Create or renew the views; they follow the tables' names, so a later save needs nothing more."""
    for name, tile in TILES.items():
        lake.define_view(name, tile.sql(), tile.comment)
