"""Data dictionary: columns, keys, references and domains of every table of the lake."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

STRING, DOUBLE, INT, LONG, DATE, BINARY = StringType(), DoubleType(), IntegerType(), LongType(), DateType(), BinaryType()
WALL_CLOCK, INSTANT = TimestampNTZType(), TimestampType()


@dataclass(frozen=True)
class Column:
    name: str
    type: DataType
    comment: str = ""


@dataclass(frozen=True)
class Table:
    """``key`` is unique; ``domains`` are SQL conditions every row fulfils.

    ``partitioned_by`` names the last columns, a folder for each of their values; ``bucketed_by`` the column
    whose equal values lie in one file, sorted.
    """

    layer: str
    name: str
    comment: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    domains: dict[str, str] = field(default_factory=dict)
    partitioned_by: tuple[str, ...] = ()
    bucketed_by: str | None = None

    @property
    def schema(self) -> StructType:
        return StructType(
            [StructField(c.name, c.type, True, {"comment": c.comment} if c.comment else None) for c in self.columns]
        )


def _text(*names: str) -> tuple[Column, ...]:
    return tuple(Column(name, STRING, "as in the file") for name in names)


# Columns of the source files, as their headers spell them.
READINGS_FILE = StructType([StructField(n, STRING) for n in ("LCLid", "tstp", "energy(kWh/hh)")])
HOUSEHOLDS_FILE = StructType(
    [StructField(n, STRING) for n in ("LCLid", "stdorToU", "Acorn", "Acorn_grouped", "file")]
)
HOLIDAYS_FILE = StructType([StructField(n, STRING) for n in ("Bank holidays", "Type")])

LINEAGE = (
    Column("_malformed_row", STRING, "the whole row, where it has too few or too many fields"),
    Column("_source_file", STRING, "file the row came from"),
    Column("_ingested_at", INSTANT, "time of ingest"),
)

METER = Column("meter_id", STRING, "meter")
DAY = Column("day", DATE, "calendar day")

WEATHER_MEASURES = {
    # column of the file -> column of the table
    "temperatureMax": "temp_max",
    "temperatureMin": "temp_min",
    "humidity": "humidity",
    "windSpeed": "wind_speed",
    "cloudCover": "cloud_cover",
    "pressure": "pressure",
    "uvIndex": "uv_index",
}
WEATHER_TEXTS = {"precipType": "precip_type", "summary": "summary"}

_WEATHER_COLUMNS = (
    Column("temp_avg", DOUBLE, "mean of temp_max and temp_min"),
    *[Column(name, DOUBLE) for name in WEATHER_MEASURES.values()],
    *[Column(name, STRING) for name in WEATHER_TEXTS.values()],
)
_DAILY_STATISTICS = (
    Column("energy_mean", DOUBLE, "mean kWh of a reading"),
    Column("energy_median", DOUBLE, "lower median kWh of a reading"),
    Column("energy_max", DOUBLE, "largest reading, kWh"),
    Column("energy_min", DOUBLE, "smallest reading, kWh"),
    Column("energy_std", DOUBLE, "sample standard deviation, kWh"),
    Column("energy_count", LONG, "readings that day"),
)
_CALENDAR = (
    Column("season", STRING, "Winter, Spring, Summer or Autumn"),
    Column("is_weekend", INT, "1 on Saturday and Sunday"),
    Column("is_holiday", INT, "1 on a bank holiday"),
)
_FLAG_DOMAINS = {
    "is_weekend": "is_weekend IN (0, 1)",
    "is_holiday": "is_holiday IN (0, 1)",
    "season": "season IN ('Winter', 'Spring', 'Summer', 'Autumn')",
}
_SLOT_DOMAIN = {"half_hour": "half_hour BETWEEN 0 AND 47"}
_TARIFF_DOMAIN = {"tariff": "tariff IN ('Standard', 'Time-of-Use')"}

BRONZE_READINGS = Table(
    "bronze", "readings", "Readings as delivered",
    _text("LCLid", "tstp", "energy_kWh_hh") + LINEAGE,
)
BRONZE_HOUSEHOLDS = Table(
    "bronze", "households", "Household list as delivered",
    _text("LCLid", "stdorToU", "Acorn", "Acorn_grouped", "file") + LINEAGE,
)
BRONZE_HOLIDAYS = Table(
    "bronze", "holidays", "Holiday list as delivered",
    _text("Bank_holidays", "Type") + LINEAGE,
)
BRONZE_WEATHER = Table(
    "bronze", "weather", "Weather as delivered, with whatever further columns the file has",
    _text("time", *WEATHER_MEASURES, *WEATHER_TEXTS) + LINEAGE,
)

SILVER_READINGS = Table(
    "silver", "readings", "Clean readings, one per meter and time",
    (
        METER,
        Column("read_at", WALL_CLOCK, "time of the reading, to the second"),
        DAY,
        Column("hour", INT, "0..23"),
        Column("half_hour", INT, "slot of the day, 0..47"),
        Column("kwh", DOUBLE, "energy of the half hour"),
        Column("year_month", INT, "month of the reading, 202401 for January 2024"),
    ),
    key=("meter_id", "read_at"),
    domains={"hour": "hour BETWEEN 0 AND 23", **_SLOT_DOMAIN},
    partitioned_by=("year_month",),
)
SILVER_DAILY = Table(
    "silver", "daily", "Statistics per meter and day, derived from the readings",
    (METER, DAY, Column("energy_sum", DOUBLE, "kWh of the day"), *_DAILY_STATISTICS),
    key=("meter_id", "day"),
    bucketed_by="meter_id",
)
SILVER_HOUSEHOLDS = Table(
    "silver", "households", "Meters with tariff and customer group",
    (
        METER,
        Column("tariff_flag", STRING, "raw tariff flag"),
        Column("tariff", STRING, "Time-of-Use or Standard"),
        Column("detail_code", STRING, "detailed customer category"),
        Column("group_raw", STRING, "raw customer group"),
        Column("group_name", STRING, "customer group, blanks made Unclassified"),
    ),
    key=("meter_id",),
    domains=_TARIFF_DOMAIN,
    bucketed_by="meter_id",
)
SILVER_METERS = Table(
    "silver", "meters", "Every meter with readings and its number",
    (METER, Column("meter_no", LONG, "number of the meter from 1; kept from save to save")),
    key=("meter_id",),
    domains={"meter_no": "meter_no > 0"},
    bucketed_by="meter_id",
)
SILVER_WEATHER = Table(
    "silver", "weather", "Weather by day",
    (DAY, *_WEATHER_COLUMNS), key=("day",),
)
SILVER_HOLIDAYS = Table(
    "silver", "holidays", "Named holidays by day",
    (DAY, Column("holiday_name", STRING)), key=("day",),
)

GOLD_FACT = Table(
    "gold", "household_day", "Fact: meter x day with tariff, group, weather and calendar",
    (
        METER,
        DAY,
        Column("daily_kwh", DOUBLE, "kWh of the day"),
        *_DAILY_STATISTICS,
        Column("tariff", STRING),
        Column("group_name", STRING),
        Column("detail_code", STRING),
        *_WEATHER_COLUMNS,
        Column("holiday_name", STRING, "null on other days"),
        Column("year", INT),
        Column("month", INT),
        Column("day_of_week", INT, "1 Sunday .. 7 Saturday"),
        *_CALENDAR,
    ),
    key=("meter_id", "day"),
    domains={
        "month": "month BETWEEN 1 AND 12",
        "day_of_week": "day_of_week BETWEEN 1 AND 7",
        **_FLAG_DOMAINS,
    },
    bucketed_by="meter_id",
)
GOLD_DAILY_TOTALS = Table(
    "gold", "daily_totals", "Demand of all homes per day",
    (
        DAY,
        *_CALENDAR,
        Column("total_kwh", DOUBLE, "kWh of all homes"),
        Column("avg_kwh_per_home", DOUBLE, "mean kWh of an active home"),
        Column("active_homes", LONG, "homes with readings that day"),
        Column("temp_avg", DOUBLE, "mean temperature"),
    ),
    key=("day",),
    domains=_FLAG_DOMAINS,
)
GOLD_GROUP_PROFILE = Table(
    "gold", "group_profile", "Consumption by customer group and tariff",
    (
        Column("group_name", STRING),
        Column("tariff", STRING),
        Column("avg_daily_kwh", DOUBLE),
        Column("median_daily_kwh", DOUBLE),
        Column("households", LONG, "distinct meters"),
    ),
    key=("group_name", "tariff"),
)
GOLD_GROUP_HOMES = Table(
    "gold", "group_homes", "Homes of each customer group, tariff and category as bitmaps of their numbers, to be rolled up",
    (
        Column("group_name", STRING),
        Column("tariff", STRING),
        Column("detail_code", STRING),
        Column("bucket", LONG, "which 32,768 numbers the bitmap is of"),
        Column("homes", BINARY, "bitmap of meter numbers"),
    ),
    key=("group_name", "tariff", "detail_code", "bucket"),
)
GOLD_LOAD_PROFILE = Table(
    "gold", "load_profile", "Average demand per half-hour slot",
    (
        Column("half_hour", INT, "slot of the day, 0..47"),
        Column("clock_time", STRING, "start of the slot"),
        Column("avg_kwh", DOUBLE),
    ),
    key=("half_hour",),
    domains=_SLOT_DOMAIN,
)
GOLD_SEGMENTS = Table(
    "gold", "segments", "Behavioural segment of each meter",
    (METER, Column("segment", INT, "0..k-1, by time of the peak")),
    key=("meter_id",),
    bucketed_by="meter_id",
)
GOLD_SEGMENT_CENTRES = Table(
    "gold", "segment_centres", "Centre of each behavioural segment, as fitted",
    (
        Column("segment", INT, "0..k-1, by time of the peak"),
        Column("half_hour", INT, "slot of the day, 0..47"),
        Column("share", DOUBLE, "share of the day's energy in the slot"),
    ),
    key=("segment", "half_hour"),
    domains=_SLOT_DOMAIN,
)
GOLD_FORECAST = Table(
    "gold", "forecast", "Predicted demand of the held-out days",
    (
        DAY,
        Column("actual", DOUBLE, "mean kWh of an active home"),
        Column("prediction", DOUBLE, "the same as predicted"),
    ),
    key=("day",),
)
GOLD_FORECAST_METRICS = Table(
    "gold", "forecast_metrics", "Errors of the forecast over the held-out days",
    (Column("rmse", DOUBLE), Column("mae", DOUBLE), Column("r2", DOUBLE, "null where all actual values are equal")),
)
GOLD_FORECAST_FEATURES = Table(
    "gold", "forecast_features", "Weight of each feature in the forecast",
    (Column("feature", STRING), Column("importance", DOUBLE, "adds up to 1")),
    key=("feature",),
)

TABLES = (
    BRONZE_READINGS, BRONZE_HOUSEHOLDS, BRONZE_HOLIDAYS, BRONZE_WEATHER,
    SILVER_READINGS, SILVER_DAILY, SILVER_HOUSEHOLDS, SILVER_METERS, SILVER_WEATHER, SILVER_HOLIDAYS,
    GOLD_FACT, GOLD_DAILY_TOTALS, GOLD_GROUP_PROFILE, GOLD_GROUP_HOMES, GOLD_LOAD_PROFILE, GOLD_SEGMENTS, GOLD_SEGMENT_CENTRES,
    GOLD_FORECAST, GOLD_FORECAST_METRICS, GOLD_FORECAST_FEATURES,
)

# (child, parent, shared key); a bank holiday is optional and therefore no reference.
REFERENCES = (
    (GOLD_FACT, SILVER_HOUSEHOLDS, "meter_id"),
    (GOLD_FACT, SILVER_WEATHER, "day"),
    (GOLD_SEGMENTS, SILVER_HOUSEHOLDS, "meter_id"),
    (GOLD_FACT, SILVER_METERS, "meter_id"),
)
