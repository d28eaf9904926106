"""The supplied tables seen as meter data.

Readings:  ``events``, a user is a meter and an event a reading.
Meter-days: ``orders``, a customer is a meter, the price scaled down is its consumption.
Households: ``customer`` with nation and region. Weather: ``lineitem`` by ship date.
Holidays: orders placed on three fixed days of the year.

The ``raw_*`` frames are text as a bronze table holds it, with the faults the cleaning is for.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.concurrency import together
from meterlake.config import SOURCE_FILES, LakeConfig
from meterlake.plans import gold, silver
from meterlake.sources.scratch import materialize, shared_folder

#: Days from the calendar of the orders to that of the events, 2000-01-01 to 2024-01-01, for the dimensions of a lake.
LAKE_DAYS = 8766
#: The readings of a lake come in so many named files.
READING_FILES = 5

KWH_DIVISOR = 9973.0  # a prime: no consumption ends in an exact half, so rounding is unambiguous

# bronze name -> header of the source file
FILE_HEADERS = {"energy_kWh_hh": "energy(kWh/hh)", "Bank_holidays": "Bank holidays"}

# columns of the weather file that the test tables have no data for, one the lake does not know; uvIndex is absent
OTHER_WEATHER_COLUMNS = {
    "windSpeed": None, "cloudCover": None, "pressure": None,
    "precipType": "rain", "summary": "none", "icon": "cloud",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed readings with slots."""
    events = table(spark, sf_dir, "events")
    return silver.with_slots(
        events.select(
            F.col("user_id").alias("meter_id"), F.col("ts").alias("read_at"), F.col("value").alias("kwh")
        )
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice: as it is, and as a copy of its key with another energy.

    Errors have the energy ``Null``, copies of purchases ``NaN``; copies of views have no time.
    """
    def padded(value):
        return F.concat(F.lit(" "), value.cast("decimal(12,2)").cast("string"), F.lit(" "))

    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("0"))
    kind = F.col("event_type")
    reading = F.struct(
        stamp.alias("tstp"),
        F.when(kind == "error", "Null").otherwise(padded(F.col("value"))).alias("energy_kWh_hh"),
    )
    copy = F.struct(
        F.when(kind == "view", "bad").otherwise(stamp).alias("tstp"),
        F.when(kind == "purchase", "NaN").otherwise(padded(F.abs(F.col("value") - 20))).alias("energy_kWh_hh"),
    )
    events = table(spark, sf_dir, "events")
    return events.select(F.col("user_id").alias("LCLid"), F.inline(F.array(reading, copy)))


def tied_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose daily sums and means often end in an exact half of the last digit that is kept."""
    cents = F.col("value").cast("decimal(12,2)").cast("decimal(18,6)")
    tied = cents + F.when(F.col("event_id") % 2 == 0, F.lit("0.00005").cast("decimal(18,6)")).otherwise(F.lit("0.1").cast("decimal(18,6)"))
    events = table(spark, sf_dir, "events")
    return events.select(F.col("user_id").alias("meter_id"), F.to_date("ts").alias("day"), tied.cast("double").alias("kwh"))


def write_uneven_readings(spark: SparkSession, sf_dir: str) -> LakeConfig:
    """Reading files of which every 50th row lacks its last field and every 49th has one too many."""
    config = new_lake(spark)
    events = table(spark, sf_dir, "events")
    stamp, number = F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("event_id")
    fields = (
        F.when(number % 50 == 0, F.array(F.col("user_id").cast("string"), stamp))
        .when(number % 49 == 0, F.array(F.col("user_id").cast("string"), stamp, F.lit("1.5"), F.lit("more")))
        .otherwise(F.array(F.col("user_id").cast("string"), stamp, F.lit("1.5")))
    )
    file = F.format_string("block_%d.csv", F.col("user_id") % READING_FILES)
    lines = events.select(file.alias("name"), F.lit(1).alias("after"), F.array_join(fields, ",").alias("value"))
    header = lines.select("name").distinct().select("name", F.lit(0).alias("after"), F.lit("LCLid,tstp,energy(kWh/hh)").alias("value"))
    # a file is one task's, its header in front
    whole = header.unionByName(lines).repartition("name").sortWithinPartitions("name", "after").select("name", "value")
    whole.write.partitionBy("name").text(config.source_path("readings").removesuffix("/*.csv"))
    return config


def raw_households(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    placed = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").join(
        region, nation.n_regionkey == region.r_regionkey, "left"
    )
    branch = F.col("c_mktsegment")
    return placed.select(
        F.col("c_custkey").alias("LCLid"),
        F.when(branch == "HOUSEHOLD", "ToU").when(branch != "BUILDING", "Std").alias("stdorToU"),
        F.col("n_name").alias("Acorn"),
        F.when(F.col("c_acctbal") < 0, None)
        .when(branch == "FURNITURE", "")
        .when(branch == "MACHINERY", "ACORN-U")
        .otherwise(F.col("r_name"))
        .alias("Acorn_grouped"),
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several stamps per day; a stamp whose temperatures are equal has no minimum.

    Written first, as a bronze table is: the text is then parsed once per stamp and not, by a
    pushed-down filter, once per line item.
    """
    lines = table(spark, sf_dir, "lineitem")
    stamps = lines.groupBy(F.to_date("l_shipdate").alias("day"), "l_linenumber").agg(
        F.max("l_quantity").alias("high"), F.min("l_quantity").alias("low"), F.max("l_discount").alias("humidity")
    )
    text = stamps.select(
        F.format_string("%s %02d:00:00", F.col("day").cast("string"), F.col("l_linenumber")).alias("time"),
        F.col("high").cast("string").alias("temperatureMax"),
        F.when(F.col("low") < F.col("high"), F.col("low").cast("string")).otherwise("Null").alias("temperatureMin"),
        F.col("humidity").cast("string").alias("humidity"),
    )
    return materialize(text, "raw-weather")


def raw_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order of such a day; pending orders have an unreadable date."""
    orders = table(spark, sf_dir, "orders")
    month, day = F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    name = (
        F.when((month == 1) & (day == 1), "New Year")
        .when((month == 12) & (day == 25), "Christmas")
        .when((month == 12) & (day == 26), "Boxing Day")
    )
    return orders.select(
        F.when(F.col("o_orderstatus") == "P", "n/a")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("Bank_holidays"),
        name.alias("Type"),
    ).filter(F.col("Type").isNotNull())


def households(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_households(raw_households(spark, sf_dir))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_weather(raw_weather(spark, sf_dir))


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_holidays(raw_holidays(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meter-days of the calendar track, unrounded."""
    orders = table(spark, sf_dir, "orders")
    priced = orders.select(
        F.col("o_custkey").alias("meter_id"),
        F.to_date("o_orderdate").alias("day"),
        (F.col("o_totalprice") / KWH_DIVISOR).alias("kwh"),
    )
    return silver.daily_statistics(priced, rounded=False)


def household_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meter-days with their household columns, for queries that need no calendar."""
    measured = daily(spark, sf_dir).select("meter_id", "day", F.col("energy_sum").alias("daily_kwh"))
    return gold.with_household(measured, households(spark, sf_dir))


@dataclass(frozen=True)
class Star:
    """The silver tables of the calendar track."""

    daily: DataFrame
    households: DataFrame
    weather: DataFrame
    holidays: DataFrame

    def fact(self) -> DataFrame:
        return gold.household_days(self.daily, self.households, self.weather, self.holidays)

    def totals(self, rounded: bool) -> DataFrame:
        return gold.daily_totals_unsaved(self.daily, self.weather, self.holidays, rounded)


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The day-level dimensions are written first, as a lake would have them saved."""
    return Star(
        daily(spark, sf_dir),
        households(spark, sf_dir),
        materialize(weather(spark, sf_dir), "weather"),
        materialize(holidays(spark, sf_dir), "holidays"),
    )


def totals(spark: SparkSession, sf_dir: str, rounded: bool) -> DataFrame:
    """Day totals in one plan: each dimension is used once, so none is written first."""
    return gold.daily_totals_unsaved(
        daily(spark, sf_dir), weather(spark, sf_dir), holidays(spark, sf_dir), rounded
    )


def new_lake(spark: SparkSession) -> LakeConfig:
    """A namespace and folders of their own."""
    run = uuid.uuid4().hex
    return LakeConfig(
        source_root=f"{shared_folder(spark)}/sources-{run}",
        namespace=f"lake_{run}",
        table_root=f"{shared_folder(spark)}/tables-{run}",
    )


def write_sources(
    spark: SparkSession, sf_dir: str, sources: tuple[str, ...] = tuple(SOURCE_FILES)
) -> LakeConfig:
    """The raw frames as CSV files under the layout a lake reads, in new folders."""
    def later(column: str):
        day = F.date_add(F.try_to_date(F.substring(column, 1, 10)), LAKE_DAYS).cast("string")
        return F.coalesce(F.concat(day, F.expr(f"substring({column}, 11)")), F.col(column))

    raw = {
        "readings": raw_readings,
        "households": lambda *at: raw_households(*at).withColumn("file", F.lit("block_0")),
        "holidays": lambda *at: raw_holidays(*at).withColumn("Bank_holidays", later("Bank_holidays")),
        "weather": lambda *at: raw_weather(*at).withColumns(
            {"time": later("time"), **{name: F.lit(value).cast("string") for name, value in OTHER_WEATHER_COLUMNS.items()}}
        ),
    }
    config = new_lake(spark)

    def write(source: str) -> None:
        rows = raw[source](spark, sf_dir)
        named = rows.withColumnsRenamed({k: v for k, v in FILE_HEADERS.items() if k in rows.columns})
        files = []
        if source == "readings":
            # folders whose names match the glob of the reading files
            named, files = named.withColumn("name", F.format_string("block_%d.csv", F.col("LCLid") % READING_FILES)), ["name"]
        named.write.partitionBy(*files).options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(config.source_path(source).removesuffix("/*.csv"))

    together(spark, [lambda source=source: write(source) for source in sources])
    return config
