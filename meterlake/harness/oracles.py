"""The registered queries once more, as SQL for DuckDB over the same parquet tables.

Fits have no twin; what holds whatever the fit has one.
"""

from __future__ import annotations

SLOTS = range(48)

_STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '0'"


def _padded(value: str) -> str:
    return f"' ' || CAST(CAST({value} AS DECIMAL(12,2)) AS VARCHAR) || ' '"


def _whole_mean(total: str, n: str, parts: int, digits: int) -> str:
    """total / parts / n in whole units of the last of so many digits, halves up; of whole numbers, so without any error."""
    return f"(2 * {total} * {10 ** digits} + {parts} * {n}) // (2 * {parts} * {n})"


# Each view names the views it needs.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_readings": ((), f"""
        SELECT user_id AS meter_id, {_STAMP} AS tstp,
               CASE WHEN event_type = 'error' THEN 'Null' ELSE {_padded('value')} END AS energy
        FROM events
        UNION ALL
        SELECT user_id, CASE WHEN event_type = 'view' THEN 'bad' ELSE {_STAMP} END,
               CASE WHEN event_type = 'purchase' THEN 'NaN' ELSE {_padded('abs(value - 20)')} END
        FROM events"""),
    "clean_readings": (("raw_readings",), """
        SELECT meter_id, read_at, min(kwh) AS kwh
        FROM (SELECT meter_id, TRY_CAST(substr(tstp, 1, 19) AS TIMESTAMP) AS read_at,
                     TRY_CAST(trim(energy) AS DOUBLE) AS kwh
              FROM raw_readings)
        WHERE read_at IS NOT NULL AND kwh IS NOT NULL AND NOT isnan(kwh)
        GROUP BY meter_id, read_at"""),
    "slots": ((), """
        SELECT user_id AS meter_id, value AS kwh, CAST(ts AS DATE) AS day,
               CAST(hour(ts) * 2 + CASE WHEN minute(ts) >= 30 THEN 1 ELSE 0 END AS INTEGER) AS half_hour
        FROM events"""),
    "load": (("slots",), """
        SELECT half_hour, round(avg(kwh), 5) AS avg_kwh,
               lpad(CAST(half_hour // 2 AS VARCHAR), 2, '0')
               || CASE WHEN half_hour % 2 = 1 THEN ':30' ELSE ':00' END AS clock_time
        FROM slots GROUP BY half_hour"""),
    "households": ((), """
        SELECT c_custkey AS meter_id, tariff_flag,
               CASE WHEN tariff_flag = 'ToU' THEN 'Time-of-Use' ELSE 'Standard' END AS tariff,
               n_name AS detail_code, group_raw,
               CASE WHEN coalesce(trim(group_raw), '') IN ('', 'ACORN-', 'ACORN-U') THEN 'Unclassified'
                    ELSE group_raw END AS group_name
        FROM (SELECT c_custkey, n_name,
                     CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'ToU'
                          WHEN c_mktsegment <> 'BUILDING' THEN 'Std' END AS tariff_flag,
                     CASE WHEN c_acctbal < 0 THEN NULL
                          WHEN c_mktsegment = 'FURNITURE' THEN ''
                          WHEN c_mktsegment = 'MACHINERY' THEN 'ACORN-U'
                          ELSE r_name END AS group_raw
              FROM customer
              LEFT JOIN nation ON c_nationkey = n_nationkey
              LEFT JOIN region ON n_regionkey = r_regionkey)"""),
    "stamps": ((), """
        SELECT CAST(l_shipdate AS DATE) AS day, l_linenumber, max(l_quantity) AS temp_max,
               CASE WHEN min(l_quantity) < max(l_quantity) THEN min(l_quantity) END AS temp_min,
               max(l_discount) AS humidity
        FROM lineitem GROUP BY 1, 2"""),
    "weather": (("stamps",), """
        SELECT day, (temp_max + temp_min) / 2 AS temp_avg, temp_max, temp_min, humidity
        FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY l_linenumber) AS nth FROM stamps)
        WHERE nth = 1"""),
    "holidays": ((), """
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS day,
               CASE WHEN month(o_orderdate) = 1 THEN 'New Year'
                    WHEN day(o_orderdate) = 25 THEN 'Christmas' ELSE 'Boxing Day' END AS holiday_name
        FROM orders
        WHERE o_orderstatus <> 'P'
          AND ((month(o_orderdate) = 1 AND day(o_orderdate) = 1)
               OR (month(o_orderdate) = 12 AND day(o_orderdate) IN (25, 26)))"""),
    "daily": ((), """
        SELECT o_custkey AS meter_id, CAST(o_orderdate AS DATE) AS day,
               sum(o_totalprice / 9973.0::DOUBLE) AS daily_kwh
        FROM orders GROUP BY 1, 2"""),
    "fact": (("daily", "households", "weather", "holidays"), """
        SELECT d.meter_id, d.day, d.daily_kwh, h.tariff, h.group_name, h.detail_code,
               w.temp_avg, w.temp_max, y.holiday_name,
               CAST(year(d.day) AS INTEGER) AS year, CAST(month(d.day) AS INTEGER) AS month,
               CAST(dayofweek(d.day) + 1 AS INTEGER) AS day_of_week,
               CAST(dayofweek(d.day) IN (0, 6) AS INTEGER) AS is_weekend,
               CAST(y.holiday_name IS NOT NULL AS INTEGER) AS is_holiday,
               CASE WHEN month(d.day) IN (12, 1, 2) THEN 'Winter'
                    WHEN month(d.day) IN (3, 4, 5) THEN 'Spring'
                    WHEN month(d.day) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season
        FROM daily d
        LEFT JOIN households h ON d.meter_id = h.meter_id
        LEFT JOIN weather w ON d.day = w.day
        LEFT JOIN holidays y ON d.day = y.day"""),
    "totals": (("fact",), """
        SELECT day, season, is_weekend, is_holiday, sum(daily_kwh) AS total_kwh,
               avg(daily_kwh) AS avg_kwh_per_home, count(DISTINCT meter_id) AS active_homes,
               max(temp_avg) AS temp_avg
        FROM fact GROUP BY day, season, is_weekend, is_holiday"""),
    "rounded_totals": (("totals",), """
        SELECT day, season, is_weekend, is_holiday, round(total_kwh, 1) AS total_kwh,
               round(avg_kwh_per_home, 3) AS avg_kwh_per_home, active_homes, round(temp_avg, 2) AS temp_avg
        FROM totals"""),
    "profile": (("fact",), """
        SELECT group_name, tariff, avg(daily_kwh) AS avg_daily_kwh,
               quantile_disc(daily_kwh, 0.5) AS median_daily_kwh, count(DISTINCT meter_id) AS households
        FROM fact GROUP BY group_name, tariff"""),
    "categories": (("fact",), """
        SELECT detail_code, avg(daily_kwh) AS kwh, count(DISTINCT meter_id) AS homes
        FROM fact GROUP BY detail_code HAVING count(DISTINCT meter_id) >= 5"""),
    "tariffs": (("profile",), """
        SELECT tariff, avg(avg_daily_kwh) AS kwh, CAST(sum(households) AS BIGINT) AS households
        FROM profile GROUP BY tariff"""),
    "seasons": (("totals",), """
        SELECT season, avg(avg_kwh_per_home) AS avg_per_home,
               avg(avg_kwh_per_home) FILTER (WHERE is_weekend = 1) AS weekend,
               avg(avg_kwh_per_home) FILTER (WHERE is_weekend = 0) AS weekday,
               avg(avg_kwh_per_home) FILTER (WHERE is_holiday = 1) AS holiday
        FROM totals GROUP BY season"""),
    "shape": (("slots",), "SELECT meter_id, " + ", ".join(
        f"coalesce(avg(kwh) FILTER (WHERE half_hour = {i}), 0) AS hh_{i}" for i in SLOTS
    ) + " FROM slots GROUP BY meter_id"),
    "days": (("rounded_totals",), """
        SELECT day, avg_kwh_per_home AS label, temp_avg, CAST(month(day) AS INTEGER) AS month,
               CAST(isodow(day) - 1 AS INTEGER) AS weekday, is_weekend, is_holiday,
               CASE season WHEN 'Autumn' THEN 0.0::DOUBLE WHEN 'Spring' THEN 1.0::DOUBLE
                           WHEN 'Summer' THEN 2.0::DOUBLE ELSE 3.0::DOUBLE END AS season_idx
        FROM rounded_totals WHERE temp_avg IS NOT NULL AND avg_kwh_per_home IS NOT NULL"""),
    "lake_readings": (("clean_readings",), """
        SELECT meter_id, CAST(read_at AS DATE) AS day, kwh FROM clean_readings"""),
    "lake_daily": (("lake_readings",), "SELECT meter_id, day, sum(kwh) AS daily_kwh FROM lake_readings GROUP BY 1, 2"),
    # the dimensions of a lake are moved to the days of the events
    "lake_weather": (("weather",), "SELECT day + 8766 AS day, temp_avg FROM weather"),
    "lake_holidays": (("holidays",), "SELECT day + 8766 AS day FROM holidays"),
    "lake_fact": (("lake_daily", "households", "lake_weather", "lake_holidays"), """
        SELECT d.meter_id, d.day, d.daily_kwh, h.tariff, h.group_name, round(w.temp_avg, 2) AS temp_avg,
               CAST(dayofweek(d.day) IN (0, 6) AS INTEGER) AS is_weekend,
               CAST(y.day IS NOT NULL AS INTEGER) AS is_holiday,
               CASE WHEN month(d.day) IN (12, 1, 2) THEN 'Winter'
                    WHEN month(d.day) IN (3, 4, 5) THEN 'Spring'
                    WHEN month(d.day) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season, h.detail_code
        FROM lake_daily d
        LEFT JOIN households h ON d.meter_id = h.meter_id
        LEFT JOIN lake_weather w ON d.day = w.day
        LEFT JOIN lake_holidays y ON d.day = y.day"""),
    # stored energies as whole numbers of their last digit: cents of a day, 0.1 and 0.001 kWh of a day's totals, 0.001 of a cell
    "lake_cents": (("lake_fact",), "SELECT *, CAST(round(daily_kwh * 100) AS HUGEINT) AS cents FROM lake_fact"),
    "lake_totals": (("lake_cents",), f"""
        SELECT day, season, is_weekend, is_holiday, temp_avg, count(*) AS active_homes,
               {_whole_mean("sum(cents)", "1", 100, 1)} AS total_tenths, {_whole_mean("sum(cents)", "count(*)", 100, 3)} AS avg_thousandths
        FROM lake_cents GROUP BY day, season, is_weekend, is_holiday, temp_avg"""),
    "lake_profile": (("lake_cents",), f"""
        SELECT group_name, tariff, count(DISTINCT meter_id) AS households, {_whole_mean("sum(cents)", "count(*)", 100, 3)} AS avg_thousandths
        FROM lake_cents GROUP BY group_name, tariff"""),
    "lake_load": (("clean_readings",), f"""
        SELECT half_hour, lpad(CAST(half_hour // 2 AS VARCHAR), 2, '0') || CASE WHEN half_hour % 2 = 1 THEN ':30' ELSE ':00' END AS clock_time,
               {_whole_mean("sum(cents)", "count(*)", 100, 5)} / 1e5::DOUBLE AS avg_kwh
        FROM (SELECT CAST(hour(read_at) * 2 + minute(read_at) // 30 AS INTEGER) AS half_hour, CAST(round(kwh * 100) AS HUGEINT) AS cents FROM clean_readings)
        GROUP BY half_hour"""),
    "tied": ((), """
        SELECT user_id AS meter_id, CAST(ts AS DATE) AS day,
               CAST(CAST(value AS DECIMAL(12,2)) * 100 AS HUGEINT) * 10000 + CASE WHEN event_id % 2 = 0 THEN 50 ELSE 100000 END AS millionths
        FROM events"""),
}


def _needed(view: str) -> list[str]:
    """A view and the views behind it, in the order they must be defined."""
    ordered: list[str] = []
    for parent in VIEWS[view][0]:
        ordered += _needed(parent)
    return list(dict.fromkeys([*ordered, view]))


def _sql(select: str, *views: str) -> str:
    names = list(dict.fromkeys(name for view in views for name in _needed(view)))
    if not names:
        return select
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in names) + "\n" + select


def _duplicates(view: str, key: str) -> str:
    return f"SELECT {key} FROM {view} GROUP BY {key} HAVING count(*) > 1"


def _pk(name: str, source: str, key: str) -> str:
    return (
        f"SELECT 'primary_key' AS \"check\", '{name}' AS table_name, count(*) AS violations "
        f"FROM ({_duplicates(source, key)})"
    )


def _fk(relation: str, child: str, parent: str, key: str) -> str:
    return (
        f"SELECT 'foreign_key' AS \"check\", '{relation}' AS table_name, count(*) AS violations "
        f"FROM {child} c WHERE c.{key} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"
    )


def _domain(table: str, source: str, rule: str, condition: str) -> str:
    return (
        f"SELECT 'domain:{rule}' AS \"check\", '{table}' AS table_name, "
        f"count(*) FILTER (WHERE NOT coalesce({condition}, FALSE)) AS violations FROM {source}"
    )


_SLOT_COLUMNS = "(SELECT hour(read_at) AS hour, hour(read_at) * 2 + (minute(read_at) // 30) AS half_hour FROM clean_readings)"
_FLAGS = {
    "is_weekend": "is_weekend IN (0, 1)",
    "is_holiday": "is_holiday IN (0, 1)",
    "season": "season IN ('Winter', 'Spring', 'Summer', 'Autumn')",
}
# Columns a saved table lacks; the weather file of the lake has no uvIndex.
_SCHEMAS = {
    "bronze.readings": 0, "bronze.households": 0, "bronze.holidays": 0, "bronze.weather": 1,
    "silver.readings": 0, "silver.daily": 0, "silver.households": 0, "silver.weather": 0, "silver.holidays": 0,
    "gold.household_day": 0, "gold.daily_totals": 0, "gold.group_profile": 0, "gold.load_profile": 0, "gold.segments": 0,
    "silver.meters": 0, "gold.group_homes": 0, "gold.segment_centres": 0,
}
_SHAPE_SUM = " + ".join(f"hh_{i}" for i in SLOTS)
_SHAPE_TOTAL = f"(CASE WHEN {_SHAPE_SUM} = 0 THEN 1 ELSE {_SHAPE_SUM} END)"

_GAP = """
    SELECT h.name AS high_name, round(h.kwh, 3) AS high_kwh, l.name AS low_name, round(l.kwh, 3) AS low_kwh,
           round((h.kwh - l.kwh) / l.kwh * 100, 1) AS gap_pct
    FROM (SELECT {name} AS name, kwh FROM {view} WHERE {name} IS NOT NULL ORDER BY kwh DESC LIMIT 1) h,
         (SELECT {name} AS name, kwh FROM {view} WHERE {name} IS NOT NULL ORDER BY kwh LIMIT 1) l"""

ORACLES: dict[str, str] = {
    "csv_ingest": _sql("""
        SELECT CAST(meter_id AS VARCHAR) AS meter_id, tstp AS read_at_text, energy AS kwh_text,
               'block_' || (meter_id % 5) || '.csv' AS source_file FROM raw_readings""", "raw_readings"),
    "medallion_roundtrip": _sql("""
        SELECT day, count(DISTINCT meter_id) AS n_meters, round(sum(kwh), 4) AS total_kwh
        FROM lake_readings GROUP BY day""", "lake_readings"),
    "layer_audit": _sql("""
        SELECT 'bronze' AS layer, 'readings' AS table_name, (SELECT count(*) FROM raw_readings) AS row_count
        UNION ALL SELECT 'bronze', 'households', (SELECT count(*) FROM customer)
        UNION ALL SELECT 'bronze', 'holidays', (SELECT count(*) FROM orders
            WHERE (month(o_orderdate) = 1 AND day(o_orderdate) = 1)
               OR (month(o_orderdate) = 12 AND day(o_orderdate) IN (25, 26)))
        UNION ALL SELECT 'bronze', 'weather', (SELECT count(*) FROM stamps)
        UNION ALL SELECT 'silver', 'readings', (SELECT count(*) FROM lake_readings)
        UNION ALL SELECT 'silver', 'daily', (SELECT count(DISTINCT (meter_id, day)) FROM lake_readings)
        UNION ALL SELECT 'silver', 'households', (SELECT count(DISTINCT c_custkey) FROM customer)
        UNION ALL SELECT 'silver', 'weather', (SELECT count(DISTINCT day) FROM stamps)
        UNION ALL SELECT 'silver', 'holidays', (SELECT count(*) FROM holidays)
        UNION ALL SELECT 'gold', 'household_day', (SELECT count(DISTINCT (meter_id, day)) FROM lake_readings)
        UNION ALL SELECT 'gold', 'daily_totals', (SELECT count(DISTINCT day) FROM lake_readings)
        UNION ALL SELECT 'gold', 'group_profile', (SELECT count(DISTINCT (group_name, tariff))
            FROM lake_readings JOIN households USING (meter_id))
        UNION ALL SELECT 'gold', 'load_profile', (SELECT count(DISTINCT hour(read_at) * 2 + minute(read_at) // 30)
            FROM clean_readings)
        UNION ALL SELECT 'gold', 'segments', (SELECT count(DISTINCT meter_id) FROM lake_readings)
        UNION ALL SELECT 'gold', 'segment_centres', 3 * 48
        UNION ALL SELECT 'silver', 'meters', (SELECT count(DISTINCT meter_id) FROM lake_readings)
        UNION ALL SELECT 'gold', 'group_homes', (SELECT count(DISTINCT (group_name, tariff, detail_code))
            FROM lake_readings JOIN households USING (meter_id))""", "lake_readings", "stamps", "households", "holidays"),
    "forecast_audit": _sql("""
        SELECT 'gold' AS layer, 'daily_totals' AS table_name, (SELECT count(*) FROM totals) AS row_count
        UNION ALL SELECT 'gold', 'forecast', (SELECT count(*) - CAST(floor(0.75 * count(*)) AS BIGINT) FROM days)
        UNION ALL SELECT 'gold', 'forecast_metrics', 1
        UNION ALL SELECT 'gold', 'forecast_features', 6""", "totals", "days"),
    "views_demand": _sql("""
        SELECT day, season, is_weekend, is_holiday, count(*) AS active_homes, temp_avg, round(sum(daily_kwh), 4) AS kwh
        FROM lake_fact GROUP BY day, season, is_weekend, is_holiday, temp_avg ORDER BY day""", "lake_fact"),
    "views_customers": _sql("""
        SELECT group_name, tariff, count(DISTINCT meter_id) AS households, count(*) AS home_days,
               round(sum(daily_kwh), 4) AS kwh
        FROM lake_fact GROUP BY group_name, tariff""", "lake_fact"),
    "csv_malformed": """
        SELECT 'block_' || (user_id % 5) || '.csv' AS source_file, count(*) AS n_rows, count(*) FILTER (bad) AS malformed,
               count(*) FILTER (event_id % 50 <> 0) AS with_energy, (SELECT count(*) FROM events WHERE event_id % 50 = 0 OR event_id % 49 = 0) AS malformed_in_all
        FROM (SELECT *, event_id % 50 = 0 OR event_id % 49 = 0 AS bad FROM events) GROUP BY 1""",
    "lake_days": _sql("""
        SELECT CAST(meter_id AS VARCHAR) AS meter_id, read_at, kwh, 202401 AS year_month FROM clean_readings
        WHERE CAST(read_at AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-17'""", "clean_readings"),
    "lake_homes_by_tariff": _sql("SELECT tariff, count(DISTINCT meter_id) AS homes FROM lake_fact GROUP BY tariff", "lake_fact"),
    "lake_homes_by_category": _sql("""
        SELECT detail_code, group_name, count(DISTINCT meter_id) AS homes FROM lake_fact GROUP BY detail_code, group_name""", "lake_fact"),
    "lake_segment_consumption": _sql("""
        SELECT count(DISTINCT meter_id) AS households, round(sum(daily_kwh), 4) AS kwh, count(*) AS days FROM lake_fact""", "lake_fact"),
    "view_tile_1_kpi": _sql(f"""
        SELECT round(sum(total_tenths) / 1e7::DOUBLE, 2) AS total_gwh,
               {_whole_mean("sum(avg_thousandths)", "count(*)", 1000, 2)} / 100.0::DOUBLE AS avg_kwh_per_home_per_day,
               max(active_homes) AS peak_active_homes, count(*) AS days_covered FROM lake_totals""", "lake_totals"),
    "view_tile_2_trend": _sql("""
        SELECT day, avg_thousandths / 1e3::DOUBLE AS avg_kwh_per_home, total_tenths / 10.0::DOUBLE AS total_kwh, active_homes
        FROM lake_totals ORDER BY day""", "lake_totals"),
    "view_tile_3_detail_category": _sql(f"""
        SELECT detail_code, {_whole_mean("sum(cents)", "count(*)", 100, 3)} / 1e3::DOUBLE AS avg_daily_kwh, count(DISTINCT meter_id) AS homes
        FROM lake_cents WHERE detail_code IS NOT NULL GROUP BY detail_code HAVING count(DISTINCT meter_id) >= 5""", "lake_cents"),
    "view_tile_4_tariff": _sql(f"""
        SELECT tariff, {_whole_mean("sum(avg_thousandths)", "count(*)", 1000, 3)} / 1e3::DOUBLE AS avg_daily_kwh, CAST(sum(households) AS BIGINT) AS households
        FROM lake_profile GROUP BY tariff""", "lake_profile"),
    "view_tile_5_demand_vs_temp": _sql("""
        SELECT temp_avg, avg_thousandths / 1e3::DOUBLE AS avg_kwh_per_home, season FROM lake_totals WHERE temp_avg IS NOT NULL""", "lake_totals"),
    "view_tile_6_season_effects": _sql(f"""
        SELECT season, {_whole_mean("sum(avg_thousandths)", "count(*)", 1000, 3)} / 1e3::DOUBLE AS avg_per_home,
               {_whole_mean("sum(avg_thousandths) FILTER (is_weekend = 1)", "nullif(count(*) FILTER (is_weekend = 1), 0)", 1000, 3)} / 1e3::DOUBLE AS weekend,
               {_whole_mean("sum(avg_thousandths) FILTER (is_weekend = 0)", "nullif(count(*) FILTER (is_weekend = 0), 0)", 1000, 3)} / 1e3::DOUBLE AS weekday,
               {_whole_mean("sum(avg_thousandths) FILTER (is_holiday = 1)", "nullif(count(*) FILTER (is_holiday = 1), 0)", 1000, 3)} / 1e3::DOUBLE AS holiday
        FROM lake_totals GROUP BY season""", "lake_totals"),
    "view_tile_7_load_curve": _sql("SELECT half_hour, clock_time, avg_kwh FROM lake_load", "lake_load"),
    "view_tile_8_segments_sum": _sql("SELECT count(DISTINCT meter_id) AS households, 3::BIGINT AS segments FROM lake_readings", "lake_readings"),
    "view_tile_9_top_households": _sql(f"""
        SELECT CAST(meter_id AS VARCHAR) AS meter_id, {_whole_mean("sum(cents)", "count(*)", 100, 2)} / 100.0::DOUBLE AS avg_daily_kwh,
               max(tariff) AS tariff, max(detail_code) AS detail_code
        FROM lake_cents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""", "lake_cents"),
    "silver_daily_exact": _sql(f"""
        SELECT meter_id, day, {_whole_mean("sum(millionths)", "1", 10**6, 4)} / 1e4::DOUBLE AS energy_sum,
               {_whole_mean("sum(millionths)", "count(*)", 10**6, 5)} / 1e5::DOUBLE AS energy_mean,
               1::BIGINT AS n_values, 5::BIGINT AS n_layouts
        FROM tied GROUP BY meter_id, day""", "tied"),
    "silver_readings": _sql("""
        SELECT meter_id, read_at, CAST(read_at AS DATE) AS day, CAST(hour(read_at) AS INTEGER) AS hour,
               CAST(hour(read_at) * 2 + CASE WHEN minute(read_at) >= 30 THEN 1 ELSE 0 END AS INTEGER) AS half_hour,
               kwh FROM clean_readings""", "clean_readings"),
    "dedup_by_key": """
        SELECT l_orderkey, l_linenumber, min(l_quantity) AS l_quantity
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "silver_daily": _sql("""
        SELECT meter_id, day, round(sum(kwh), 4) AS energy_sum, round(avg(kwh), 5) AS energy_mean,
               quantile_disc(kwh, 0.5) AS energy_median, max(kwh) AS energy_max, min(kwh) AS energy_min,
               round(stddev_samp(kwh), 5) AS energy_std, count(kwh) AS energy_count
        FROM slots GROUP BY meter_id, day""", "slots"),
    "silver_households": _sql("SELECT * FROM households", "households"),
    "silver_weather": _sql("SELECT * FROM weather", "weather"),
    "dedup_households": _sql("SELECT * FROM households", "households"),
    "dedup_weather_stamps": _sql("SELECT * FROM weather", "weather"),
    "silver_holidays": _sql("SELECT * FROM holidays", "holidays"),
    "gold_fact": _sql("SELECT * REPLACE (round(daily_kwh, 4) AS daily_kwh) FROM fact", "fact"),
    "gold_daily_totals": _sql("SELECT * FROM rounded_totals", "rounded_totals"),
    "gold_daily_totals_from_fact": _sql("SELECT * FROM rounded_totals", "rounded_totals"),
    "gold_group_profile": _sql("""
        SELECT group_name, tariff, round(avg_daily_kwh, 3) AS avg_daily_kwh,
               round(median_daily_kwh, 3) AS median_daily_kwh, households FROM profile""", "profile"),
    "gold_load_profile": _sql("SELECT half_hour, clock_time, avg_kwh FROM load", "load"),
    "tile_1_kpi": _sql("""
        SELECT round(sum(total_kwh) / 1e6::DOUBLE, 2) AS total_gwh,
               round(avg(avg_kwh_per_home), 2) AS avg_kwh_per_home_per_day,
               max(active_homes) AS peak_active_homes, count(*) AS days_covered FROM totals""", "totals"),
    "tile_2_trend": _sql("""
        SELECT day, avg_kwh_per_home, total_kwh, active_homes FROM rounded_totals ORDER BY day""", "rounded_totals"),
    "tile_3_detail_category": _sql("""
        SELECT detail_code, round(kwh, 3) AS avg_daily_kwh, homes FROM categories
        WHERE detail_code IS NOT NULL ORDER BY 2 DESC""", "categories"),
    "tile_4_tariff": _sql("""
        SELECT tariff, round(kwh, 3) AS avg_daily_kwh, households FROM tariffs ORDER BY 2 DESC""", "tariffs"),
    "tile_4_tariff_weighted": _sql("""
        SELECT tariff, round(avg(daily_kwh), 3) AS avg_daily_kwh, count(DISTINCT meter_id) AS households
        FROM fact GROUP BY tariff ORDER BY 2 DESC""", "fact"),
    "tile_5_demand_vs_temp": _sql("""
        SELECT temp_avg, avg_kwh_per_home, season FROM rounded_totals WHERE temp_avg IS NOT NULL""",
        "rounded_totals"),
    "tile_6_season_effects": _sql("""
        SELECT season, round(avg_per_home, 3) AS avg_per_home, round(weekend, 3) AS weekend,
               round(weekday, 3) AS weekday, round(holiday, 3) AS holiday
        FROM seasons ORDER BY 2 DESC""", "seasons"),
    "tile_7_load_curve": _sql("SELECT half_hour, clock_time, avg_kwh FROM load ORDER BY half_hour", "load"),
    "tile_9_top_households": _sql("""
        SELECT meter_id, round(avg(daily_kwh), 2) AS avg_daily_kwh, max(tariff) AS tariff,
               max(detail_code) AS detail_code
        FROM fact GROUP BY meter_id ORDER BY avg_daily_kwh DESC, meter_id LIMIT 15""", "fact"),
    "insight_2_group": _sql("""
        SELECT group_name, round(avg(avg_daily_kwh), 3) AS avg_daily_kwh,
               CAST(sum(households) AS BIGINT) AS homes
        FROM profile WHERE group_name <> 'Unclassified' GROUP BY group_name ORDER BY 2 DESC""", "profile"),
    "insight_2_detail": _sql("""
        SELECT detail_code, round(kwh, 6) AS kwh, homes FROM categories ORDER BY kwh""", "categories"),
    "insight_4_scatter": _sql("""
        SELECT temp_avg, avg_kwh_per_home FROM rounded_totals
        WHERE temp_avg IS NOT NULL AND avg_kwh_per_home IS NOT NULL""", "rounded_totals"),
    "insight_4_correlation": _sql(
        "SELECT round(corr(temp_avg, avg_kwh_per_home), 6) AS r FROM totals", "totals"),
    "finding_peak_slots": _sql("""
        SELECT half_hour, clock_time, avg_kwh FROM load ORDER BY avg_kwh DESC, half_hour LIMIT 6""", "load"),
    "finding_category_gap": _sql(_GAP.format(name="detail_code", view="categories"), "categories"),
    "finding_tariff_gap": _sql(_GAP.format(name="tariff", view="tariffs"), "tariffs"),
    "finding_season_gap": _sql("""
        SELECT 'Winter' AS high_name, round(w.avg_per_home, 3) AS high_kwh,
               'Summer' AS low_name, round(s.avg_per_home, 3) AS low_kwh,
               round((w.avg_per_home - s.avg_per_home) / s.avg_per_home * 100, 1) AS gap_pct
        FROM (SELECT avg_per_home FROM seasons WHERE season = 'Winter') w,
             (SELECT avg_per_home FROM seasons WHERE season = 'Summer') s""", "seasons"),
    "contract_pk": _sql(" UNION ALL ".join([
        _pk("lineitem", "lineitem", "l_orderkey, l_linenumber"),
        _pk("raw_readings", "raw_readings", "meter_id, tstp"),
        _pk("raw_weather", "stamps", "day"),
        _pk("readings", "clean_readings", "meter_id, read_at"),
        _pk("households", "households", "meter_id"),
        _pk("weather", "weather", "day"),
        _pk("holidays", "holidays", "day"),
        _pk("household_day", "fact", "meter_id, day"),
        _pk("daily_totals", "totals", "day"),
        _pk("group_profile", "profile", "group_name, tariff"),
        _pk("load_profile", "load", "half_hour"),
    ]), "clean_readings", "profile", "totals", "load"),
    "contract_fk": _sql(" UNION ALL ".join([
        _fk("household_day -> households", "daily", "households", "meter_id"),
        _fk("household_day -> weather", "daily", "weather", "day"),
        _fk("household_day -> holidays (optional)", "daily", "holidays", "day"),
        _fk("segments -> households", "(SELECT DISTINCT meter_id FROM slots)", "households", "meter_id"),
    ]), "fact", "slots"),
    "contract_domain": _sql(" UNION ALL ".join([
        _domain("readings_late", f"(SELECT hour + 12 AS hour FROM {_SLOT_COLUMNS})", "hour", "hour BETWEEN 0 AND 23"),
        _domain("readings_late", f"(SELECT half_hour + 24 AS half_hour FROM {_SLOT_COLUMNS})", "half_hour", "half_hour BETWEEN 0 AND 47"),
        _domain("readings", _SLOT_COLUMNS, "hour", "hour BETWEEN 0 AND 23"),
        _domain("readings", _SLOT_COLUMNS, "half_hour", "half_hour BETWEEN 0 AND 47"),
        _domain("households", "households", "tariff", "tariff IN ('Standard', 'Time-of-Use')"),
        _domain("household_day", "fact", "month", "month BETWEEN 1 AND 12"),
        _domain("household_day", "fact", "day_of_week", "day_of_week BETWEEN 1 AND 7"),
        *[_domain("household_day", "fact", name, rule) for name, rule in _FLAGS.items()],
        *[_domain("daily_totals", "totals", name, rule) for name, rule in _FLAGS.items()],
        _domain("load_profile", "load", "half_hour", "half_hour BETWEEN 0 AND 47"),
    ]), "clean_readings", "totals", "load"),
    "contract_lake": _sql(" UNION ALL ".join([
        *[f"SELECT 'schema' AS \"check\", '{name}' AS table_name, {n} AS violations" for name, n in _SCHEMAS.items()],
        _pk("silver.readings", "clean_readings", "meter_id, read_at"),
        _pk("silver.daily", "lake_daily", "meter_id, day"),
        _pk("silver.households", "households", "meter_id"),
        _pk("silver.weather", "lake_weather", "day"),
        _pk("silver.holidays", "lake_holidays", "day"),
        _pk("gold.household_day", "lake_fact", "meter_id, day"),
        _pk("gold.daily_totals", "(SELECT DISTINCT day, season, temp_avg FROM lake_fact)", "day"),
        _pk("gold.group_profile", "(SELECT DISTINCT group_name, tariff FROM lake_fact)", "group_name, tariff"),
        _pk("gold.load_profile", f"(SELECT DISTINCT half_hour FROM {_SLOT_COLUMNS})", "half_hour"),
        _pk("gold.segments", "(SELECT DISTINCT meter_id FROM lake_daily)", "meter_id"),
        _pk("silver.meters", "(SELECT DISTINCT meter_id FROM lake_daily)", "meter_id"),
        "SELECT 'primary_key', 'gold.segment_centres', 0",
        _pk("gold.group_homes", "(SELECT DISTINCT group_name, tariff, detail_code FROM lake_fact)", "group_name, tariff, detail_code"),
        "SELECT 'domain:meter_no', 'silver.meters', 0",
        "SELECT 'domain:half_hour', 'gold.segment_centres', 0",
        _fk("household_day -> meters", "lake_daily", "(SELECT DISTINCT meter_id FROM lake_daily)", "meter_id"),
        _domain("silver.readings", _SLOT_COLUMNS, "hour", "hour BETWEEN 0 AND 23"),
        _domain("silver.readings", _SLOT_COLUMNS, "half_hour", "half_hour BETWEEN 0 AND 47"),
        _domain("silver.households", "households", "tariff", "tariff IN ('Standard', 'Time-of-Use')"),
        _domain("gold.household_day", "lake_fact", "month", "month(day) BETWEEN 1 AND 12"),
        _domain("gold.household_day", "lake_fact", "day_of_week", "dayofweek(day) + 1 BETWEEN 1 AND 7"),
        *[_domain(f"gold.{table}", "lake_fact", name, rule) for table in ("household_day", "daily_totals") for name, rule in _FLAGS.items()],
        _domain("gold.load_profile", _SLOT_COLUMNS, "half_hour", "half_hour BETWEEN 0 AND 47"),
        _fk("household_day -> households", "lake_daily", "households", "meter_id"),
        _fk("household_day -> weather", "lake_daily", "lake_weather", "day"),
        _fk("segments -> households", "(SELECT DISTINCT meter_id FROM lake_daily)", "households", "meter_id"),
    ]), "clean_readings", "lake_fact"),
    "ml_load_shape": _sql(
        "SELECT meter_id, " + ", ".join(f"round(hh_{i}, 6) AS hh_{i}" for i in SLOTS) + " FROM shape", "shape"),
    "ml_load_shape_l1": _sql(
        "SELECT meter_id, " + ", ".join(f"round(hh_{i} / total, 6) AS hh_{i}" for i in SLOTS)
        + f" FROM (SELECT *, CASE WHEN {_SHAPE_SUM} = 0 THEN 1 ELSE {_SHAPE_SUM} END AS total FROM shape)", "shape"),
    "ml_segments_cover_meters": _sql("""
        SELECT count(DISTINCT meter_id) AS n_rows, count(DISTINCT meter_id) AS meters, true AS in_range FROM slots""", "slots"),
    "ml_segments_nearest": _sql("SELECT count(DISTINCT meter_id) AS meters, 0::BIGINT AS not_nearest FROM slots", "slots"),
    "ml_segment_centres_are_means": "SELECT 144::BIGINT AS n, 0::BIGINT AS apart",
    "ml_forecast_proofs": """
        SELECT * FROM (VALUES ('beats the mean', true), ('weights add up to one', true), ('predicts the same again', true)) AS t("check", holds)""",
    "ml_segment_sizes_sum": _sql("SELECT count(DISTINCT meter_id) AS households FROM slots", "slots"),
    "ml_segment_curves_mean": _sql(
        "SELECT half_hour, round(avg(share), 6) AS share FROM ("
        + " UNION ALL ".join(f"SELECT {i}::INTEGER AS half_hour, hh_{i} / {_SHAPE_TOTAL} AS share FROM shape" for i in SLOTS)
        + ") GROUP BY half_hour", "shape"),
    "ml_segment_totals": _sql("""
        SELECT round(sum(kwh), 4) AS kwh, count(DISTINCT (meter_id, day)) AS days FROM slots WHERE kwh IS NOT NULL""", "slots"),
    "ml_forecast_held_out": _sql("""
        SELECT day, round(label, 6) AS actual, true AS predicted
        FROM (SELECT *, row_number() OVER (ORDER BY day) <= floor(0.75 * count(*) OVER ()) AS is_train FROM days)
        WHERE NOT is_train""", "days"),
    "ml_forecast_baseline": _sql("""
        SELECT round(sqrt(avg((label - m) ** 2)), 6) AS rmse, round(avg(abs(label - m)), 6) AS mae,
               round(1 - avg((label - m) ** 2) / var_pop(label), 6) AS r2
        FROM (SELECT *, avg(label) FILTER (is_train) OVER () AS m
              FROM (SELECT *, row_number() OVER (ORDER BY day) <= floor(0.75 * count(*) OVER ()) AS is_train FROM days))
        WHERE NOT is_train""", "days"),
    "ml_forecast_features": _sql("SELECT * FROM days", "days"),
    "ml_time_split": _sql("""
        SELECT day, row_number() OVER (ORDER BY day) <= floor(0.75 * count(*) OVER ()) AS is_train
        FROM days""", "days"),
}
