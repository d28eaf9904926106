"""Dirty CSV files to gold tables, and the table store itself."""

from __future__ import annotations

import datetime
import pathlib

import pytest
from frames import rows
from pyspark.errors import AnalysisException

from meterlake import tables as t
from meterlake.config import LakeConfig, object_store_root, volume_root
from meterlake.plans import pipeline, quality
from meterlake.plans.quality import schema_differences
from meterlake.sources.csv_files import read_csv, with_lineage
from meterlake.sources.lake import Lake
from meterlake.sources.scratch import materialize, shared_folder

D = datetime.date

READINGS_1 = """LCLid,tstp,energy(kWh/hh)
MAC1,2013-01-01 00:00:00.0000000, 0.5 
MAC1,2013-01-01 00:30:00.0000000,Null
MAC1,2013-01-01 01:00:00.0000000, 0.25 
MAC2,2013-01-01 00:00:00.0000000, 2 
MAC2,nonsense, 2 
"""
READINGS_2 = """LCLid,tstp,energy(kWh/hh)
MAC1,2013-01-01 00:00:00.0000000, 0.5 
MAC1,2013-01-02 23:30:00.0000000, 1.5 
MAC3,2013-01-02 12:10:00.0000000, 3 
"""
HOUSEHOLDS = """LCLid,stdorToU,Acorn,Acorn_grouped,file
MAC1,Std,ACORN-A,Affluent,block_0
MAC2,ToU,ACORN-U,ACORN-U,block_0
MAC2,ToU,ACORN-U,ACORN-U,block_0
MAC9,Std,ACORN-C,,block_1
"""
# columns in another order than the dictionary's, and two it does not know
WEATHER = """temperatureMax,icon,windSpeed,pressure,humidity,temperatureMin,time,precipType,summary,cloudCover,uvIndex,moonPhase
8,rain,3,1000,0.9,2,2013-01-01 00:00:00,rain,Wet,0.5,1,0.1
9,rain,3,1000,0.9,3,2013-01-01 06:00:00,rain,Wetter,0.5,1,0.1
oops,fog,3,1000,0.9,3,2013-01-02 00:00:00,rain,Foggy,0.5,1,0.2
"""
HOLIDAYS = """Bank holidays,Type
2013-01-01,New Year's Day
2013-01-01,New Year's Day
someday,Broken
"""


@pytest.fixture
def lake(spark, tmp_path):
    source = tmp_path / "source" / "landing"
    for name, text in {
        "halfhourly/block_0.csv": READINGS_1,
        "halfhourly/block_1.csv": READINGS_2,
        "households/informations_households.csv": HOUSEHOLDS,
        "households/acorn_details.csv": "MAIN CATEGORIES,CATEGORIES\nx,y\n",
        "weather/weather_daily_darksky.csv": WEATHER,
        "calendar/uk_bank_holidays.csv": HOLIDAYS,
    }.items():
        path = source / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    config = LakeConfig(
        source_root=str(tmp_path / "source"), source_folder="/landing/",
        namespace=f"t{abs(hash(str(tmp_path)))}", table_root=str(tmp_path / "tables"),
    )
    return Lake(spark, config)


def test_sources_to_gold(lake):
    pipeline.run(lake)

    bronze = lake.read(t.BRONZE_READINGS)
    assert bronze.columns == ["LCLid", "tstp", "energy_kWh_hh", "_malformed_row", "_source_file", "_ingested_at"]
    assert bronze.count() == 8
    assert {r[0].rsplit("/", 1)[1] for r in bronze.select("_source_file").distinct().collect()} == {
        "block_0.csv", "block_1.csv",
    }
    assert {r[0] for r in bronze.select("energy_kWh_hh").collect()} >= {" 0.5 ", "Null"}
    assert "moonPhase" in lake.read(t.BRONZE_WEATHER).columns

    assert rows(lake.read(t.SILVER_READINGS), "meter_id", "half_hour", "kwh") == [
        ("MAC1", 0, 0.5), ("MAC1", 2, 0.25), ("MAC1", 47, 1.5), ("MAC2", 0, 2.0), ("MAC3", 24, 3.0),
    ]
    assert rows(lake.read(t.SILVER_WEATHER), "day", "temp_avg", "temp_max", "summary") == [
        (D(2013, 1, 1), 5.0, 8.0, "Wet"), (D(2013, 1, 2), None, None, "Foggy"),
    ]
    fact = lake.read(t.GOLD_FACT)
    assert rows(fact, "meter_id", "day", "daily_kwh", "energy_count", "tariff", "group_name", "is_holiday") == [
        ("MAC1", D(2013, 1, 1), 0.75, 2, "Standard", "Affluent", 1),
        ("MAC1", D(2013, 1, 2), 1.5, 1, "Standard", "Affluent", 0),
        ("MAC2", D(2013, 1, 1), 2.0, 1, "Time-of-Use", "Unclassified", 1),
        ("MAC3", D(2013, 1, 2), 3.0, 1, None, None, 0),
    ]
    assert rows(lake.read(t.GOLD_DAILY_TOTALS), "day", "total_kwh", "avg_kwh_per_home", "active_homes") == [
        (D(2013, 1, 1), 2.8, 1.375, 2), (D(2013, 1, 2), 4.5, 2.25, 2),
    ]
    assert lake.read(t.GOLD_LOAD_PROFILE).count() == 4

    # what is saved is what the dictionary says
    assert len(lake.saved()) == 17
    for table in lake.saved():
        if table.layer != "bronze":
            assert schema_differences(lake.read(table), table) == []
    comments = {f.name: f.metadata.get("comment") for f in fact.schema.fields}
    assert comments["daily_kwh"] == "kWh of the day"

    assert lake.tables("silver") == ["daily", "holidays", "households", "meters", "readings", "weather"]
    assert lake.preview(t.GOLD_FACT, 2).count() == 2


def test_views_serve_sql(spark, lake):
    pipeline.run(lake)
    lake.register_views()
    found = spark.sql("SELECT day, total_kwh FROM daily_totals ORDER BY total_kwh DESC LIMIT 1").first()
    assert tuple(found) == (D(2013, 1, 2), 4.5)


def test_a_second_run_gives_the_same_tables_and_adds_to_the_audit(spark, lake):
    pipeline.run(lake)
    kept = [t.SILVER_READINGS, t.SILVER_DAILY, t.GOLD_FACT, t.GOLD_DAILY_TOTALS, t.GOLD_GROUP_PROFILE]
    first = {table.name: rows(lake.read(table)) for table in kept}
    again = Lake(spark, lake.config)
    pipeline.run(again)
    assert {table.name: rows(again.read(table)) for table in kept} == first

    audit = spark.table(lake.config.table("gold", "audit"))
    assert audit.select("run_id").distinct().count() == 2
    counted = {(r.layer, r.table_name): r.row_count for r in audit.filter(audit.run_id == lake.run_id).collect()}
    for (layer, name), count in counted.items():
        assert spark.table(lake.config.table(layer, name)).count() == count
    assert len(counted) == 17


def test_a_new_catalog_takes_over_the_files_of_an_old_one(spark, lake):
    lake.create_schemas()
    first = spark.createDataFrame([(0, "00:00", 1.0), (1, "00:30", 2.0)], "half_hour int, clock_time string, avg_kwh double")
    lake.save(first, t.GOLD_LOAD_PROFILE)
    spark.sql(f"DROP VIEW {lake.config.table('gold', 'load_profile')}")
    saved = lake.save(first.limit(1), t.GOLD_LOAD_PROFILE)
    assert rows(saved) == [(0, "00:00", 1.0)]


def test_a_failed_save_leaves_the_old_table(spark, lake):
    lake.create_schemas()
    first = spark.createDataFrame([(0, "00:00", 1.0), (1, "00:30", 2.0)], "half_hour int, clock_time string, avg_kwh double")
    lake.save(first, t.GOLD_LOAD_PROFILE)
    broken = first.selectExpr("half_hour", "clock_time", "IF(half_hour = 1, raise_error('lost'), avg_kwh) AS avg_kwh")
    with pytest.raises(Exception, match="lost"):
        lake.save(broken, t.GOLD_LOAD_PROFILE)
    assert rows(lake.read(t.GOLD_LOAD_PROFILE)) == rows(first)


def test_a_table_can_be_made_from_itself_and_leaves_the_last_two_versions(spark, lake):
    lake.create_schemas()
    first = spark.createDataFrame([(0, "00:00", 1.0), (1, "00:30", 2.0)], "half_hour int, clock_time string, avg_kwh double")
    lake.save(first, t.GOLD_LOAD_PROFILE)
    saved = lake.save(lake.read(t.GOLD_LOAD_PROFILE).filter("half_hour = 1"), t.GOLD_LOAD_PROFILE)
    assert rows(saved) == [(1, "00:30", 2.0)]
    for _ in range(3):
        lake.save(lake.read(t.GOLD_LOAD_PROFILE), t.GOLD_LOAD_PROFILE)
    assert len(list(pathlib.Path(lake.config.location("gold", "load_profile")).iterdir())) == 2
    assert len([v for v in spark.catalog.listTables(lake.config.versions("gold")) if not v.isTemporary]) == 2
    assert lake.tables("gold") == ["load_profile"]


def test_tables_of_the_warehouse_are_replaced_too(spark, tmp_path):
    lake = Lake(spark, LakeConfig(str(tmp_path), namespace=f"w{abs(hash(str(tmp_path)))}"))
    lake.create_schemas()
    first = spark.createDataFrame([(0, "00:00", 1.0)], "half_hour int, clock_time string, avg_kwh double")
    lake.save(first, t.GOLD_LOAD_PROFILE)
    assert rows(lake.save(first.selectExpr("half_hour + 1 AS half_hour", "clock_time", "avg_kwh"), t.GOLD_LOAD_PROFILE)) == [(1, "00:00", 1.0)]
    assert lake.tables("gold") == ["load_profile"]


def test_declared_tables_can_be_created_first(spark, lake):
    lake.create_tables()
    assert sum(len(lake.tables(layer)) for layer in ("bronze", "silver", "gold")) == 20
    for table in t.TABLES:
        empty = lake.read(table)
        assert schema_differences(empty, table) == []
        assert empty.count() == 0
    pipeline.run(lake)
    assert lake.read(t.GOLD_FACT).count() == 4
    described = spark.catalog.getTable(lake.config.table("gold", "household_day"))
    assert described.description == t.GOLD_FACT.comment


def test_rows_that_do_not_fit_the_dictionary_are_refused(spark, lake):
    lake.create_schemas()
    with pytest.raises(AnalysisException):
        lake.save(spark.createDataFrame([(0, [1.0])], "half_hour int, avg_kwh array<double>"), t.GOLD_LOAD_PROFILE)


def test_an_optional_source_may_be_absent(spark, tmp_path):
    lake = Lake(spark, LakeConfig(str(tmp_path), namespace="absent", table_root=str(tmp_path / "tables")))
    lake.create_schemas()
    assert lake.ingest("holidays", t.BRONZE_HOLIDAYS, t.HOLIDAYS_FILE, optional=True) is None
    with pytest.raises(AnalysisException):
        lake.ingest("holidays", t.BRONZE_HOLIDAYS, t.HOLIDAYS_FILE)
    assert [(r.table_name, r.status, r.row_count) for r in lake.write_audit().collect()] == [
        ("holidays", "skipped", None)
    ]


def test_a_file_of_another_shape_fails(spark, tmp_path):
    (tmp_path / "good.csv").write_text("LCLid,tstp,energy(kWh/hh)\nA,2013-01-01 00:00:00,1\n")
    (tmp_path / "swapped.csv").write_text("tstp,LCLid,energy(kWh/hh)\n2013-01-01 00:00:00,A,1\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path / "*.csv"), t.READINGS_FILE).collect()


def test_lineage_names_and_caller_options(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a b;c(d)\n1;2\n")
    landed = with_lineage(read_csv(spark, str(tmp_path / "x.csv"), sep=";"))
    assert landed.columns == ["a_b", "c_d", "_malformed_row", "_source_file", "_ingested_at"]
    assert tuple(landed.select("a_b", "c_d").first()) == ("1", "2")


def test_source_paths():
    config = LakeConfig(object_store_root("acct", "box") + "/", source_folder="/in/")
    assert config.source_path("readings") == "abfss://box@acct.dfs.core.windows.net/in/halfhourly/*.csv"
    assert LakeConfig(volume_root("main", "meters")).source_path("holidays") == (
        "/Volumes/main/meters/raw/calendar/uk_bank_holidays.csv"
    )
    assert LakeConfig("/x", namespace="n", catalog="c").table("gold", "load_profile") == "c.n_gold.load_profile"
    with pytest.raises(ValueError):
        config.table("platinum", "x")


def test_scratch_tables_lie_in_the_folder_the_session_names(spark):
    frame = spark.range(10).selectExpr("id", "id * 2 AS twice")
    saved = materialize(frame, "numbers")
    assert rows(saved) == rows(frame)
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert all(folder in path for path in saved.inputFiles())


def test_checks_find_what_is_broken(lake):
    pipeline.run(lake)
    counted = {(r["check"], r.table_name): r.violations for r in quality.check(lake).collect()}
    assert {k: v for k, v in counted.items() if v} == {
        ("foreign_key", "household_day -> households"): 1, ("foreign_key", "segments -> households"): 1,
    }
    assert ("schema", "gold.segments") in counted and ("primary_key", "silver.readings") in counted
    assert not any("forecast" in name for _, name in counted)

    loads = lake.read(t.GOLD_LOAD_PROFILE)
    broken = materialize(loads.unionAll(loads.limit(1)).selectExpr("half_hour + 24 AS half_hour", "clock_time", "avg_kwh"), "broken")
    lake.save(broken, t.GOLD_LOAD_PROFILE)
    counted = {(r["check"], r.table_name): r.violations for r in quality.check(lake).collect()}
    assert counted["primary_key", "gold.load_profile"] == 1
    assert counted["domain:half_hour", "gold.load_profile"] == broken.filter("half_hour > 47").count() > 0


def test_absent_weather_columns_are_on_record(spark, lake, tmp_path):
    file = tmp_path / "source" / "landing" / "weather" / "weather_daily_darksky.csv"
    file.write_text("time,temperatureMin,humidity\n2013-01-01 00:00:00,2,0.9\n")
    pipeline.run(lake)
    counted = {(r["check"], r.table_name): r.violations for r in quality.check(lake).collect()}
    assert counted["schema", "bronze.weather"] == 7
    audit = spark.table(lake.config.table("gold", "audit"))
    assert audit.filter("layer = 'bronze' AND table_name = 'weather'").first().status.startswith("saved without temperatureMax, windSpeed")


def test_forecast_is_saved(spark, lake):
    lake.create_schemas()
    days = spark.range(40).selectExpr(
        "date_add(DATE'2013-01-01', CAST(id AS INT)) AS day", "'Winter' AS season", "0 AS is_weekend", "0 AS is_holiday",
        "10D AS total_kwh", "10 - id / 10 AS avg_kwh_per_home", "5L AS active_homes", "CAST(id AS DOUBLE) AS temp_avg",
    )
    lake.save(days, t.GOLD_DAILY_TOTALS)
    pipeline.build_forecast(lake, trees=3)
    assert lake.read(t.GOLD_FORECAST).count() == 10
    assert lake.read(t.GOLD_FORECAST_METRICS).first().rmse > 0
    assert sum(r.importance for r in lake.read(t.GOLD_FORECAST_FEATURES).collect()) == pytest.approx(1)
