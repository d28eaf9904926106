"""The saved lake, layer by layer. Every step overwrites its tables, so any step can be repeated.

Tables that do not depend on each other are saved together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from meterlake import tables as t
from meterlake.concurrency import together
from meterlake.plans import forecast, gold, segments, silver, tiles
from meterlake.sources.lake import Lake


def land_sources(lake: Lake) -> None:
    """Bronze: the readings as many files, the three dimensions as one file each."""
    lake.create_schemas()
    together(
        lake.spark,
        [
            lambda: lake.ingest("readings", t.BRONZE_READINGS, t.READINGS_FILE),
            lambda: lake.ingest("households", t.BRONZE_HOUSEHOLDS, t.HOUSEHOLDS_FILE),
            lambda: lake.ingest("holidays", t.BRONZE_HOLIDAYS, t.HOLIDAYS_FILE),
            # columns beyond the known ones are kept
            lambda: lake.ingest("weather", t.BRONZE_WEATHER),
        ],
    )


def build_silver(lake: Lake) -> None:
    def readings_and_daily() -> None:
        readings = silver.clean_readings(lake.read(t.BRONZE_READINGS), by_month=True)
        saved = lake.save(readings, t.SILVER_READINGS)
        build_daily(lake, saved)

    together(
        lake.spark,
        [
            readings_and_daily,
            lambda: lake.save(silver.clean_households(lake.read(t.BRONZE_HOUSEHOLDS)), t.SILVER_HOUSEHOLDS),
            lambda: lake.save(silver.clean_weather(lake.read(t.BRONZE_WEATHER)), t.SILVER_WEATHER),
            lambda: lake.save(silver.clean_holidays(lake.read(t.BRONZE_HOLIDAYS)), t.SILVER_HOLIDAYS),
        ],
    )


def build_daily(lake: Lake, readings: DataFrame) -> None:
    daily = lake.save(silver.daily_statistics(readings, exact=True), t.SILVER_DAILY)
    numbered = lake.read(t.SILVER_METERS) if lake.current_version(t.SILVER_METERS) else None
    lake.save(silver.number_meters(daily, numbered), t.SILVER_METERS)


def resave_months(lake: Lake, months: Sequence[int]) -> None:
    """Clean the readings of some months again (202401 for January 2024) and replace these months alone; then all that follows.

    For bronze that has got new files for old months. The files of other months are not written.
    """
    readings = silver.clean_readings(lake.read(t.BRONZE_READINGS), by_month=True, months=months)
    build_daily(lake, lake.save_partitions(readings, t.SILVER_READINGS, [(month,) for month in months]))
    build_gold(lake)


def build_gold(lake: Lake) -> None:
    def fact_and_its_marts() -> None:
        fact = lake.save(
            gold.household_days(
                lake.read(t.SILVER_DAILY),
                lake.read(t.SILVER_HOUSEHOLDS),
                lake.read(t.SILVER_WEATHER),
                lake.read(t.SILVER_HOLIDAYS),
            ),
            t.GOLD_FACT,
        )
        together(
            lake.spark,
            [
                lambda: lake.save(gold.daily_totals(fact, exact=True), t.GOLD_DAILY_TOTALS),
                lambda: lake.save(gold.group_profile(fact, exact=True), t.GOLD_GROUP_PROFILE),
                lambda: lake.save(gold.group_homes(fact, lake.read(t.SILVER_METERS)), t.GOLD_GROUP_HOMES),
            ],
        )

    together(
        lake.spark,
        [
            fact_and_its_marts,
            lambda: lake.save(gold.load_profile(lake.read(t.SILVER_READINGS), exact=True), t.GOLD_LOAD_PROFILE),
        ],
    )


def build_segments(lake: Lake) -> None:
    """Labels and centres of one fit."""
    labels, centres = segments.fitted_segments(lake.read(t.SILVER_READINGS))
    lake.save(labels, t.GOLD_SEGMENTS)
    lake.save(centres, t.GOLD_SEGMENT_CENTRES)


def build_forecast(lake: Lake, trees: int = forecast.TREES) -> None:
    """One fit on the saved day totals: predictions, errors and weights. It needs weather for days on both sides of the split."""
    save_forecast(lake, forecast.fit_forecast(forecast.features(lake.read(t.GOLD_DAILY_TOTALS)), trees))


def save_forecast(lake: Lake, fitted: forecast.Forecast) -> None:
    predicted = lake.save(fitted.predictions, t.GOLD_FORECAST)
    lake.save(forecast.metrics(predicted), t.GOLD_FORECAST_METRICS)
    lake.save(forecast.importances(fitted), t.GOLD_FORECAST_FEATURES)


def run(lake: Lake) -> None:
    """Sources to gold tables without the forecast, then the audit of the run."""
    land_sources(lake)
    build_silver(lake)
    build_gold(lake)
    build_segments(lake)
    tiles.define(lake)
    lake.write_audit()
