"""Every registered query: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import tables as t
from meterlake.harness import inputs
from meterlake.operators.dedup import smallest_value
from meterlake.operators.pivot import SLOT_COLUMNS
from meterlake.plans import dashboard, findings, forecast, gold, pipeline, quality, segments, silver, tiles
from meterlake.sources.lake import Lake
from meterlake.sources.scratch import materialize

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(rows: DataFrame, digits: int, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.round(c, digits) for c in columns})


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _once(build: Callable[[SparkSession, str], object]) -> Callable[[SparkSession, str], object]:
    """What several queries read is built once for a session and a folder of tables; its results lie in saved files."""
    found = functools.lru_cache(maxsize=8)(lambda application, spark, sf_dir: build(spark, sf_dir))
    return lambda spark, sf_dir: found(spark.sparkContext.applicationId, spark, sf_dir)


# bronze and the saved lake


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, inputs.write_sources(spark, sf_dir, ("readings",)))
    lake.create_schemas()
    bronze = lake.ingest("readings", t.BRONZE_READINGS, t.READINGS_FILE)
    return bronze.select(
        F.col("LCLid").alias("meter_id"),
        F.col("tstp").alias("read_at_text"),
        F.col("energy_kWh_hh").alias("kwh_text"),
        F.regexp_extract("_source_file", "/halfhourly/name=([^/]+)/", 1).alias("source_file"),
    )


def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with too few or too many fields: kept in bronze with their text, counted by the save for the audit."""
    lake = Lake(spark, inputs.write_uneven_readings(spark, sf_dir))
    lake.create_schemas()
    bronze = lake.ingest("readings", t.BRONZE_READINGS, t.READINGS_FILE)
    audited = lake.write_audit().filter(F.col("run_id") == lake.run_id).first().malformed_rows
    files = bronze.groupBy(F.regexp_extract("_source_file", "/halfhourly/name=([^/]+)/", 1).alias("source_file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_malformed_row").alias("malformed"), F.count("energy_kWh_hh").alias("with_energy")
    )
    return files.withColumn("malformed_in_all", F.lit(audited).cast("long"))


@_once
def _built_lake(spark: SparkSession, sf_dir: str) -> Lake:
    lake = Lake(spark, inputs.write_sources(spark, sf_dir))
    pipeline.run(lake)
    return lake


def medallion_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _built_lake(spark, sf_dir)
    consumed = lake.read(t.GOLD_FACT).groupBy("day").agg(F.round(F.sum("daily_kwh"), 4).alias("total_kwh"))
    homes = lake.read(t.GOLD_DAILY_TOTALS).select("day", F.col("active_homes").alias("n_meters"))
    return homes.join(consumed, "day").select("day", "n_meters", "total_kwh")


def layer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _built_lake(spark, sf_dir)
    audit = spark.table(lake.config.table("gold", "audit"))
    return audit.filter(F.col("run_id") == lake.run_id).select("layer", "table_name", "row_count")


#: Tiles as SQL over the views of a saved lake.
VIEW_DEMAND = """
    SELECT t.day, t.season, t.is_weekend, t.is_holiday, t.active_homes, t.temp_avg, f.kwh
    FROM daily_totals t
    JOIN (SELECT day, round(sum(daily_kwh), 4) AS kwh FROM household_day GROUP BY day) f ON t.day = f.day
    ORDER BY t.day"""
VIEW_CUSTOMERS = """
    SELECT p.group_name, p.tariff, p.households, f.home_days, f.kwh
    FROM group_profile p
    JOIN (SELECT h.group_name, h.tariff, count(*) AS home_days, round(sum(h.daily_kwh), 4) AS kwh
          FROM household_day h JOIN segments s ON h.meter_id = s.meter_id
          GROUP BY h.group_name, h.tariff) f
      ON p.group_name <=> f.group_name AND p.tariff <=> f.tariff"""


def views_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    _built_lake(spark, sf_dir).register_views()
    return spark.sql(VIEW_DEMAND)


def views_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts only what has one segment per meter, so it differs where a meter has none or two."""
    _built_lake(spark, sf_dir).register_views()
    return spark.sql(VIEW_CUSTOMERS)


def lake_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of ten days of a saved lake, read from the folder of their month alone."""
    days = _built_lake(spark, sf_dir).read_days(t.SILVER_READINGS, datetime.date(2024, 1, 8), datetime.date(2024, 1, 17))
    return days.select("meter_id", "read_at", "kwh", "year_month")


def lake_homes_by_tariff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct homes of each tariff, rolled up from the bitmaps of finer cells."""
    return dashboard.distinct_homes(_built_lake(spark, sf_dir).read(t.GOLD_GROUP_HOMES), "tariff")


def lake_homes_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.distinct_homes(_built_lake(spark, sf_dir).read(t.GOLD_GROUP_HOMES), "detail_code", "group_name")


def lake_segment_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments' energy from the saved fact and segments, both bucketed by meter; summed up, whatever the fit."""
    lake = _built_lake(spark, sf_dir)
    totals = dashboard.segment_totals(lake.read(t.SILVER_DAILY), lake.read(t.GOLD_SEGMENTS))
    return totals.agg(F.sum("households").alias("households"), F.round(F.sum("kwh"), 4).alias("kwh"), F.sum("days").alias("days"))


def _tile_of_lake(name: str) -> Query:
    """A tile read by name from the views of a saved lake."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.table(_built_lake(spark, sf_dir).config.table("gold", name))

    query.__name__ = f"view_{name}"
    return query


def view_tile_8_segments_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whatever the fit: the homes of the segments in the saved tile add up to the meters."""
    return _tile_of_lake("tile_8_segments")(spark, sf_dir).agg(F.sum("households").alias("households"), F.count("*").alias("segments"))


def contract_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks on a saved lake, whose weather file lacks a column."""
    return quality.check(_built_lake(spark, sf_dir))


def forecast_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the forecast step saves, from saved day totals."""
    lake = Lake(spark, inputs.new_lake(spark))
    lake.create_schemas()
    lake.save(gold_daily_totals(spark, sf_dir), t.GOLD_DAILY_TOTALS)
    pipeline.save_forecast(lake, _forecast(spark, sf_dir))
    return lake.write_audit().select("layer", "table_name", "row_count")


# silver


def silver_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_readings(inputs.raw_readings(spark, sf_dir))


def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return smallest_value(lines, ["l_orderkey", "l_linenumber"], "l_quantity")


def silver_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.daily_statistics(inputs.readings(spark, sf_dir))


def silver_daily_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and means on half ties, over five layouts of the same rows: each value, and how many values there were.

    The layouts differ in the number of tasks that a meter-day's rows are dealt to, and in their order; all grow with the partitions
    of a shuffle, so that no task holds a fixed share of the readings.
    """
    readings = inputs.tied_readings(spark, sf_dir)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    layouts = [readings.repartition(n * tasks) for n in (1, 2, 3, 7)] + [readings.repartitionByRange(5 * tasks, F.desc("kwh"))]
    every = _union([silver.daily_statistics(rows, exact=True).select("meter_id", "day", "energy_sum", "energy_mean") for rows in layouts])
    return every.groupBy("meter_id", "day").agg(
        F.max("energy_sum").alias("energy_sum"), F.max("energy_mean").alias("energy_mean"),
        (F.countDistinct("energy_sum", "energy_mean")).alias("n_values"), F.count(F.lit(1)).alias("n_layouts"),
    )


def silver_households(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.households(spark, sf_dir)


def silver_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.weather(spark, sf_dir).select("day", "temp_avg", "temp_max", "temp_min", "humidity")


def dedup_households(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every household again with all but its id missing: the filled row stays."""
    raw = inputs.raw_households(spark, sf_dir)
    empty = raw.select("LCLid", *[F.lit(None).cast("string").alias(c) for c in raw.columns if c != "LCLid"])
    return silver.clean_households(raw.unionByName(empty))


def dedup_weather_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stamp again with an unreadable time and other values, and once more without values: neither stays."""
    raw = inputs.raw_weather(spark, sf_dir)
    unreadable = raw.select(
        F.concat(F.substring("time", 1, 10), F.lit(" xx")).alias("time"),
        *[F.lit("-99").alias(c) for c in raw.columns if c != "time"],
    )
    empty = raw.select("time", *[F.lit(None).cast("string").alias(c) for c in raw.columns if c != "time"])
    dated = silver.clean_weather(raw.unionByName(unreadable).unionByName(empty))
    return dated.select("day", "temp_avg", "temp_max", "temp_min", "humidity")


def silver_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.holidays(spark, sf_dir)


# gold


def gold_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = inputs.star(spark, sf_dir).fact().select(
        "meter_id", "day", "daily_kwh", "tariff", "group_name", "detail_code", "temp_avg", "temp_max",
        "holiday_name", "year", "month", "day_of_week", "is_weekend", "is_holiday", "season",
    )
    return _rounded(fact, 4, "daily_kwh")


def gold_daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.totals(spark, sf_dir, rounded=True)


def gold_daily_totals_from_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_totals(inputs.star(spark, sf_dir).fact())


def gold_group_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.group_profile(inputs.household_fact(spark, sf_dir))


def gold_load_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.load_profile(inputs.readings(spark, sf_dir))


# dashboard tiles and insights


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.totals(spark, sf_dir, rounded=False)


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group profile without its median, which no tile reads."""
    return gold.group_consumption(inputs.household_fact(spark, sf_dir), rounded=False)


def tile_1_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.kpis(_totals(spark, sf_dir))


def tile_2_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.demand_trend(gold_daily_totals(spark, sf_dir))


def tile_3_detail_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.detail_categories(inputs.household_fact(spark, sf_dir))


def insight_2_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.detail_categories_with_unknown(inputs.household_fact(spark, sf_dir), digits=6)


def insight_2_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.group_ranking(_profile(spark, sf_dir))


def tile_4_tariff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.tariff_comparison(_profile(spark, sf_dir))


def tile_4_tariff_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.tariff_comparison_weighted(inputs.household_fact(spark, sf_dir))


def tile_5_demand_vs_temp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.demand_against_temperature(gold_daily_totals(spark, sf_dir))


def insight_4_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.temperature_scatter(gold_daily_totals(spark, sf_dir))


def insight_4_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.temperature_correlation(_totals(spark, sf_dir))


def tile_6_season_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.season_effects(_totals(spark, sf_dir))


def tile_7_load_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.load_curve(gold_load_profile(spark, sf_dir))


def tile_8_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.segment_sizes(ml_segments(spark, sf_dir))


def tile_9_top_households(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.top_households(inputs.household_fact(spark, sf_dir))


def segment_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = silver.daily_statistics(inputs.readings(spark, sf_dir), rounded=False)
    return dashboard.segment_consumption(daily, ml_segments(spark, sf_dir))


# findings


def finding_peak_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings.peak_slots(gold_load_profile(spark, sf_dir))


def finding_category_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = dashboard.detail_categories(inputs.household_fact(spark, sf_dir), digits=None)
    return findings.gap(categories, "detail_code", "avg_daily_kwh")


def finding_tariff_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    tariffs = dashboard.tariff_comparison(_profile(spark, sf_dir), digits=None)
    return findings.gap(tariffs, "tariff", "avg_daily_kwh")


def finding_season_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings.season_gap(dashboard.season_effects(_totals(spark, sf_dir), digits=None))


# contracts


def contract_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = inputs.star(spark, sf_dir)
    raw_weather = inputs.raw_weather(spark, sf_dir).select(F.substring("time", 1, 10).alias("day"))
    checked = [
        (inputs.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"),
        (inputs.raw_readings(spark, sf_dir), ["LCLid", "tstp"], "raw_readings"),
        (raw_weather, ["day"], "raw_weather"),
        (silver_readings(spark, sf_dir), t.SILVER_READINGS.key, "readings"),
        (star.households, t.SILVER_HOUSEHOLDS.key, "households"),
        (star.weather, t.SILVER_WEATHER.key, "weather"),
        (star.holidays, t.SILVER_HOLIDAYS.key, "holidays"),
        (star.fact(), t.GOLD_FACT.key, "household_day"),
        (star.totals(rounded=True), t.GOLD_DAILY_TOTALS.key, "daily_totals"),
        (gold_group_profile(spark, sf_dir), t.GOLD_GROUP_PROFILE.key, "group_profile"),
        (gold_load_profile(spark, sf_dir), t.GOLD_LOAD_PROFILE.key, "load_profile"),
    ]
    return _union([quality.duplicate_keys(rows, key, name) for rows, key, name in checked])


def contract_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = inputs.star(spark, sf_dir)
    return _union([
        quality.orphans(star.daily, star.households, "meter_id", "household_day -> households"),
        quality.orphans(star.daily, star.weather, "day", "household_day -> weather"),
        quality.orphans(star.daily, star.holidays, "day", "household_day -> holidays (optional)"),
        quality.orphans(ml_segments(spark, sf_dir), star.households, "meter_id", "segments -> households"),
    ])


def contract_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = inputs.star(spark, sf_dir)
    readings = silver_readings(spark, sf_dir)
    # half a day late, so that the afternoon leaves its domains
    late = readings.withColumns({"hour": F.col("hour") + 12, "half_hour": F.col("half_hour") + 24})
    return _union([
        quality.outside_domains(late, t.SILVER_READINGS.domains, "readings_late"),
        *[
            quality.outside_domains(rows, table.domains, table.name)
            for rows, table in [
                (readings, t.SILVER_READINGS),
                (star.households, t.SILVER_HOUSEHOLDS),
                (star.fact(), t.GOLD_FACT),
                (star.totals(rounded=True), t.GOLD_DAILY_TOTALS),
                (gold_load_profile(spark, sf_dir), t.GOLD_LOAD_PROFILE),
            ]
        ],
    ])


# models


def ml_load_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(segments.load_shape(inputs.readings(spark, sf_dir)), 6, *SLOT_COLUMNS)


@_once
def _shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pivot of the readings for the fit and for all that is read beside it."""
    return materialize(segments.share_of_day(segments.load_shape(inputs.readings(spark, sf_dir))), "shares-of-day")


def ml_load_shape_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_shares(spark, sf_dir), 6, *SLOT_COLUMNS)


def ml_silhouette_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.silhouettes(segments.shape_vectors(_shares(spark, sf_dir)))


@_once
def _fitted_segments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    labels, centres = segments.fitted_shares(_shares(spark, sf_dir))
    return materialize(labels, "segments"), materialize(centres, "segment-centres")


def ml_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted_segments(spark, sf_dir)[0]


def ml_segments_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each meter against every centre of the fit: none is nearer to another segment's centre than to its own."""
    labels, centres = _fitted_segments(spark, sf_dir)
    return segments.nearness(_shares(spark, sf_dir), labels, centres)


def ml_segment_centres_are_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each centre of the fit is the mean shape of its meters: the fit has come to rest."""
    labels, centres = _fitted_segments(spark, sf_dir)
    means = segments.segment_curves(_shares(spark, sf_dir), labels).withColumnRenamed("share", "mean")
    apart = F.abs(F.col("share") - F.col("mean"))
    return centres.join(means, ["segment", "half_hour"], "full").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(apart < 1e-3, F.lit(False))).alias("apart")
    )


def ml_segment_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_curves(_shares(spark, sf_dir), ml_segments(spark, sf_dir))


def ml_segments_cover_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whatever the fit: every meter has one segment, and they are numbered from 0 to 2."""
    labelled = ml_segments(spark, sf_dir)
    in_range = F.coalesce(F.min("segment") >= 0, F.lit(False)) & (F.max("segment") < segments.SEGMENTS)
    return labelled.agg(F.count("*").alias("n_rows"), F.countDistinct("meter_id").alias("meters"), in_range.alias("in_range"))


def ml_segment_sizes_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whatever the fit: the sizes of the segments add up to the meters."""
    return tile_8_segments(spark, sf_dir).agg(F.sum("households").alias("households"))


def ml_segment_curves_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whatever the fit: the curves weighted by the sizes are the mean share of all meters."""
    shares, labelled = _shares(spark, sf_dir), ml_segments(spark, sf_dir)
    sized = segments.segment_curves(shares, labelled).join(dashboard.segment_sizes(labelled), "segment")
    mean = F.sum(F.col("share") * F.col("households")) / F.sum("households")
    return sized.groupBy("half_hour").agg(F.round(mean, 6).alias("share"))


def ml_segment_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whatever the fit: energy and meter-days of the segments add up to all of them."""
    daily = silver.daily_statistics(inputs.readings(spark, sf_dir), rounded=False)
    totals = dashboard.segment_totals(daily, ml_segments(spark, sf_dir))
    return totals.agg(F.round(F.sum("kwh"), 4).alias("kwh"), F.sum("days").alias("days"))


def ml_forecast_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.features(gold_daily_totals(spark, sf_dir))


def ml_time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.time_split(ml_forecast_features(spark, sf_dir)).select("day", "is_train")


@_once
def _forecast(spark: SparkSession, sf_dir: str) -> forecast.Forecast:
    return forecast.fit_forecast(ml_forecast_features(spark, sf_dir))


def ml_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forecast(spark, sf_dir).predictions


def ml_forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.metrics(_forecast(spark, sf_dir).predictions)


def ml_forecast_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The held-out days, their actual values, and whether a prediction is there."""
    found = _forecast(spark, sf_dir).predictions
    return found.select("day", F.round("actual", 6).alias("actual"), F.col("prediction").isNotNull().alias("predicted"))


def ml_forecast_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the mean of the training days: what the model has to beat."""
    split = forecast.time_split(ml_forecast_features(spark, sf_dir))
    return _rounded(forecast.metrics(forecast.mean_baseline(split)), 6, "rmse", "mae", "r2")


def ml_forecast_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of a sound fit, whatever the data."""
    return forecast.proofs(_forecast(spark, sf_dir))


def ml_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.importances(_forecast(spark, sf_dir))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        csv_ingest, csv_malformed, medallion_roundtrip, layer_audit, forecast_audit, views_demand, views_customers,
        lake_days, lake_homes_by_tariff, lake_homes_by_category, lake_segment_consumption,
        *[_tile_of_lake(name) for name in tiles.TILES], view_tile_8_segments_sum,
        silver_readings, dedup_by_key, silver_daily, silver_daily_exact, silver_households, silver_weather, silver_holidays,
        dedup_households, dedup_weather_stamps,
        gold_fact, gold_daily_totals, gold_daily_totals_from_fact, gold_group_profile, gold_load_profile,
        tile_1_kpi, tile_2_trend, tile_3_detail_category, tile_4_tariff, tile_4_tariff_weighted,
        tile_5_demand_vs_temp, tile_6_season_effects, tile_7_load_curve, tile_8_segments, tile_9_top_households,
        insight_2_group, insight_2_detail, insight_4_scatter, insight_4_correlation, segment_consumption,
        finding_peak_slots, finding_category_gap, finding_tariff_gap, finding_season_gap,
        contract_pk, contract_fk, contract_domain, contract_lake,
        ml_load_shape, ml_load_shape_l1, ml_silhouette_sweep, ml_segments, ml_segment_curves,
        ml_segments_nearest, ml_segment_centres_are_means, ml_segments_cover_meters, ml_segment_sizes_sum, ml_segment_curves_mean, ml_segment_totals,
        ml_forecast_held_out, ml_forecast_baseline, ml_forecast_features, ml_time_split, ml_forecast, ml_forecast_metrics, ml_forecast_proofs, ml_feature_importance,
    )
}
