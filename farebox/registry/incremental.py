"""Incremental loads and refresh on the test tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.operators.conform import evolve_union
from farebox.operators.mergeable import merge_state
from farebox.operators.quality import quality_gate
from farebox.operators.rowsets import difference_counts, union_all
from farebox.operators.summaries import average_fare_in_area
from farebox.plans import integrate as wide
from farebox.plans import products as p
from farebox.plans import refresh as r
from farebox.plans.updates import load_update, merge_insert_only, update_log
from farebox.registry import roles
from farebox.registry.enrich import INTEGRATED_COLUMNS
from farebox.registry.products import AIR_SQL, MOBILITY_SQL, WEATHER_SQL, ZONE_SQL
from farebox.registry.sql import (
    HISTORY,
    INTEGRATED,
    LINE_KEY,
    LINE_REST,
    NEW_LINES,
    OLD_LINES,
    ROLES,
    TRIPS,
    UPDATE,
    exact_mean,
    half_up,
    one_per_key,
    whole_means,
    with_,
)
from farebox.sources.city import trips_spec
from farebox.sources.descriptor import DatasetSpec
from farebox.sources.scratch import scratch_path
from farebox.sources.tables import Table
from farebox.streaming.updates import update_stream

KEY = ("l_orderkey", "l_linenumber")
LINE_COLUMNS = [*KEY, *LINE_REST.split(", ")]

LINE_SPEC = DatasetSpec.from_dict(
    "lines",
    {
        "format": "parquet",
        "path": "",
        "primary_keys": list(KEY),
        "schema": {
            **dict.fromkeys(("l_orderkey", "l_partkey", "l_suppkey"), "long"),
            "l_linenumber": "integer",
            **dict.fromkeys(("l_quantity", "l_extendedprice", "l_discount", "l_tax"), "double"),
            **dict.fromkeys(("l_returnflag", "l_linestatus"), "string"),
            "l_shipdate": "timestamp",
        },
    },
)


# -- loads ---------------------------------------------------------------------------


def merge_new_keys(spark, sf_dir):
    """Lines of the update whose key history does not have."""
    old, new = roles.split_lines(spark, sf_dir)
    return roles.plain(merge_insert_only(new, old, KEY))


def _loaded_lines(spark, sf_dir):
    """History stored, then the update merged in, with an added column."""
    old, new = roles.split_lines(spark, sf_dir)
    table = Table(spark, scratch_path(spark, "lines"))
    table.append(quality_gate(old, KEY))
    grown = new.withColumn("l_note", F.concat(F.lit(" "), F.col("l_returnflag")))
    return table, load_update(table, grown, LINE_SPEC)


def merge_into_table(spark, sf_dir):
    table, _ = _loaded_lines(spark, sf_dir)
    return roles.plain(table.read(with_batch=True))


def _loaded_trips(spark, sf_dir):
    history, update = roles.split(
        roles.raw_trips(spark, sf_dir), "tpep_pickup_datetime", roles.HISTORY_END, roles.UPDATE_START
    )
    table = Table(spark, scratch_path(spark, "trips"))
    spec = trips_spec(name="taxi_trips")
    table.append(roles.convert_booleans(roles.standardize_columns(history), spec.booleans))
    again = update.filter(F.col("trip_distance").isNull())
    return table, load_update(table, update.unionByName(again), spec, event_time="tpep_pickup_datetime")


def append_novel_trips(spark, sf_dir):
    table, _ = _loaded_trips(spark, sf_dir)
    return roles.plain(table.read(with_batch=True))


def update_records(spark, sf_dir):
    """The update log, without its time."""
    records = [_loaded_lines(spark, sf_dir)[1], _loaded_trips(spark, sf_dir)[1]]
    return update_log(spark, records).drop("elapsed_s")


def evolve_schema_append(spark, sf_dir):
    """Old rows read NULL in an added column, new rows in a column they no longer bring."""
    history, update = roles.split_trips(spark, sf_dir)
    names = ["vendor_id", "tpep_pickup_datetime"]
    old = history.select(*names, "tip_amount")
    return roles.plain(evolve_union(old, update.select(*names, F.col("passenger_count").alias("aqi"))))


def stream_update(spark, sf_dir):
    """The trip update arriving as files in a folder, loaded by the file stream."""
    history, update = roles.split(
        roles.raw_trips(spark, sf_dir), "tpep_pickup_datetime", roles.HISTORY_END, roles.UPDATE_START
    )
    spec = trips_spec(name="taxi_trips")
    table = Table(spark, scratch_path(spark, "streamed"))
    table.append(roles.convert_booleans(roles.standardize_columns(history), spec.booleans))
    landing = scratch_path(spark, "landing")
    update.write.parquet(landing)
    stream = update_stream(
        table, spec, landing, scratch_path(spark, "stream-state"), update.schema, event_time="tpep_pickup_datetime"
    )
    stream.awaitTermination()
    return roles.plain(table.read())


# -- versions ------------------------------------------------------------------------------


def _three_batches(spark, sf_dir) -> Table:
    orders = roles.table(spark, sf_dir, "orders")
    table = Table(spark, scratch_path(spark, "orders"))
    for status in ("O", "F", "P"):
        table.append(orders.filter(F.col("o_orderstatus") == status))
    return table


def read_asof(spark, sf_dir):
    """Rows as of version 1 and rows added after it."""
    table = _three_batches(spark, sf_dir)
    kept = table.read(as_of=1).withColumn("part", F.lit("as_of"))
    return roles.plain(kept.unionByName(table.read(since=1).withColumn("part", F.lit("since"))))


def table_history(spark, sf_dir):
    history = _three_batches(spark, sf_dir).history(2)
    return history.select("_batch_id", "row_count", F.col("committed_at").isNotNull().alias("committed"))


# -- integrated table, backfill and products ---------------------------------------------------

def _raw_catalog(spark, sf_dir, *specs: p.ProductSpec, two_layouts: bool = False) -> r.Catalog:
    """Raw tables at their first version: trips to the cut, weather and air two days less; with some of the products."""
    products = {spec.name: spec for spec in specs}
    catalog = replace(roles.new_catalog(spark), products=products, two_layouts=two_layouts)
    history, _ = roles.split_trips(spark, sf_dir)
    catalog.table("trips").append(history)
    before = F.lit(roles.UPDATE_START).cast("timestamp")
    catalog.table("weather").append(roles.weather(spark, sf_dir).filter(F.col("timestamp") < before))
    catalog.table("air_quality").append(roles.air_quality(spark, sf_dir).filter(F.col("datetime_local") < before))
    catalog.table("zones").append(roles.zones(spark, sf_dir))
    return catalog


def _load_updates(catalog: r.Catalog, spark, sf_dir) -> None:
    """New trips, late weather with an added column, and late air quality."""
    _, update = roles.split_trips(spark, sf_dir)
    spec = replace(trips_spec(name="trips"), booleans=())
    typed = replace(spec, columns={**spec.columns, "store_and_fwd_flag": T.BooleanType()})
    load_update(catalog.table("trips"), update, typed, event_time="tpep_pickup_datetime")
    since = F.lit(roles.UPDATE_START).cast("timestamp")
    late = roles.weather(spark, sf_dir).filter(F.col("timestamp") >= since)
    catalog.table("weather").append(late.withColumn("humidity", F.col("rhum") + 1))
    catalog.table("air_quality").append(roles.air_quality(spark, sf_dir).filter(F.col("datetime_local") >= since))


def _refreshed(spark, sf_dir, *specs: p.ProductSpec, two_layouts: bool = False) -> r.Catalog:
    """First build, then the updates, then two refreshes (the second must do nothing)."""
    catalog = _raw_catalog(spark, sf_dir, *specs, two_layouts=two_layouts)
    r.refresh(catalog)
    _load_updates(catalog, spark, sf_dir)
    done = r.refresh(catalog)
    if sorted(done) != sorted(catalog.products) or r.refresh(catalog):
        raise RuntimeError(f"unexpected refresh: {done}")
    return catalog


def stored_state(spark, sf_dir):
    """Baseline of the tables, recorded once and read back, with the rows each version holds."""
    catalog = _raw_catalog(spark, sf_dir)
    if not r.bootstrap_state(catalog) or r.bootstrap_state(catalog):
        raise RuntimeError("the baseline must be recorded exactly once")
    state = r.load_state(catalog)
    counts = [
        catalog.table(name).read().agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name in catalog.raw
    ]
    columns = F.size("columns").alias("column_count")
    return state.join(union_all(counts), "table_name").select("table_name", "version", columns, "row_count")


def detect_table_changes(spark, sf_dir):
    catalog = _raw_catalog(spark, sf_dir)
    before = r.current_state(catalog)
    _load_updates(catalog, spark, sf_dir)
    changes = r.detect_changes(before, r.current_state(catalog))
    joined = [F.concat_ws(",", c).alias(c) for c in ("added", "removed", "retyped")]
    counts = [
        catalog.table(name).read(since=0).agg(F.lit(name).alias("table_name"), F.count("*").alias("new_rows"))
        for name in catalog.raw
    ]
    return changes.join(union_all(counts), "table_name").select(
        "table_name", "old_version", "new_version", *joined, "status", "new_rows"
    )


def products_to_refresh(spark, sf_dir):
    """Products that depend on a table with a new version, by a join with the dependency rows."""
    catalog = _raw_catalog(spark, sf_dir)
    before = r.current_state(catalog)
    since = F.lit(roles.UPDATE_START).cast("timestamp")
    catalog.table("weather").append(roles.weather(spark, sf_dir).filter(F.col("timestamp") >= since))
    changed = r.detect_changes(before, r.current_state(catalog)).filter(F.col("status") == "changed")
    behind = r.products_behind(changed, r.dependency_frame(spark))
    return behind.withColumn("n_new", F.lit(catalog.table("weather").read(since=0).count()).cast("long"))


def refresh_late_station(spark, sf_dir):
    """Trips with the air quality of their hour, when a second station reports after the first refresh."""
    catalog = _raw_catalog(spark, sf_dir)
    air = catalog.table("air_quality").read()
    r.refresh(catalog)
    late = air.withColumns({"site_num": F.lit("late"), "sample_measurement": F.col("sample_measurement") + 20})
    catalog.table("air_quality").append(late)
    r.refresh(catalog)
    columns = ["vendor_id", "tpep_pickup_datetime", "air_q_sample_measurement", "air_q_measurements"]
    return roles.plain(catalog.integrated.read().where("air_q_matched").select(*columns))


def reload_table(spark, sf_dir):
    """Demand per zone after the trips have been loaded, extended, and loaded afresh with the history only."""
    catalog = _raw_catalog(spark, sf_dir, p.ZONE_STATISTICS)
    trips = catalog.table("trips")
    _, update = roles.split_trips(spark, sf_dir)
    history = trips.read()
    trips.append(update)
    r.refresh(catalog)
    change = trips.change()
    change.start_at(2)
    change.put(history, 2)
    change.publish()
    r.refresh(catalog)
    shown = p.read_product(catalog.product("taxi_zone_statistics"), p.ZONE_STATISTICS)
    return shown.groupBy("pu_zone").agg(F.sum("taxi_demand").alias("taxi_demand"))


def increment_integration(spark, sf_dir):
    """Integrated table after a second batch of trips, with the batch each trip came in."""
    catalog = _raw_catalog(spark, sf_dir)
    r.extend_integrated(catalog)
    _, update = roles.split_trips(spark, sf_dir)
    newer = update.filter(F.col("tpep_pickup_datetime") >= F.lit(roles.HISTORY_END).cast("timestamp"))
    catalog.table("trips").append(newer)
    r.extend_integrated(catalog)
    columns = ["vendor_id", "tpep_pickup_datetime", "weather_prcp", "weather_matched", "pu_zone", "do_zone"]
    return roles.plain(
        catalog.integrated.read(with_batch=True).select(*columns, "air_q_sample_measurement", "_batch_id")
    )


def backfill_late_weather(spark, sf_dir):
    """Weather of the afternoon hours arrives late and brings a new column."""
    weather = roles.weather(spark, sf_dir)
    catalog = roles.new_catalog(spark)
    catalog.table("trips").append(roles.trips(spark, sf_dir))
    catalog.table("weather").append(weather.filter(F.col("hour") < 12))
    catalog.table("air_quality").append(roles.air_quality(spark, sf_dir))
    catalog.table("zones").append(roles.zones(spark, sf_dir))
    r.extend_integrated(catalog)
    late = weather.filter(F.col("hour") >= 12).withColumn("humidity", F.col("rhum") + 1)
    catalog.table("weather").append(late)
    r.backfill_weather(catalog, 0)
    columns = ["vendor_id", "tpep_pickup_datetime", "weather_matched", "weather_temp", "weather_prcp"]
    return roles.plain(catalog.integrated.read().select(*columns, "weather_humidity", "pu_zone"))


def backfill_late_air(spark, sf_dir):
    """Air quality of the last days arrives late, several stations per area and hour, with an added column."""
    air = roles.air_quality(spark, sf_dir)
    catalog = roles.new_catalog(spark)
    catalog.table("trips").append(roles.trips(spark, sf_dir))
    catalog.table("weather").append(roles.weather(spark, sf_dir))
    catalog.table("zones").append(roles.zones(spark, sf_dir))
    early, late = roles.split(air, "datetime_local", roles.UPDATE_START, roles.UPDATE_START)
    catalog.table("air_quality").append(early)
    r.extend_integrated(catalog)
    catalog.table("air_quality").append(late.withColumn("aqi", F.col("site_num").cast("int") * 2))
    r.backfill_air(catalog, 0)
    columns = ["vendor_id", "tpep_pickup_datetime", "pu_borough", "air_q_matched", "air_q_site_num", "air_q_aqi"]
    return roles.plain(
        catalog.integrated.read().select(*columns, "air_q_sample_measurement", "air_q_measurements")
    )


def product_merge_sum(spark, sf_dir):
    """Zone statistics of history plus those of the newer trips, merged without rescanning history."""
    spec = p.ZONE_STATISTICS
    zoned = wide.with_zones(roles.trips(spark, sf_dir), roles.zones(spark, sf_dir))
    history, newer = roles.split(zoned, "tpep_pickup_datetime", roles.HISTORY_END, roles.HISTORY_END)
    table = Table(spark, scratch_path(spark, "zone-statistics"))
    p.store_product(table, p.product_state(history, spec), spec, "history")
    merged = p.merged_state(table, newer, spec)
    return roles.plain(p.present(merged, spec))


def mobility_merge_sum(spark, sf_dir):
    """The same for the weekday-and-hour summary."""
    spec = p.MOBILITY_SUMMARY
    history, newer = roles.split(
        roles.trips(spark, sf_dir), "tpep_pickup_datetime", roles.HISTORY_END, roles.HISTORY_END
    )
    states = [p.product_state(history, spec), p.product_state(newer, spec)]
    return p.present(merge_state(states, spec.key_names, spec.measures), spec)


def refreshed_integrated(spark, sf_dir):
    catalog = _refreshed(spark, sf_dir)
    return roles.plain(catalog.integrated.read().select(*INTEGRATED_COLUMNS))


def layouts_agree(spark, sf_dir):
    """Mean fare of one borough from the borough layout of a refreshed catalog, after both layouts were compared whole."""
    catalog = _refreshed(spark, sf_dir, two_layouts=True)
    columns = [*INTEGRATED_COLUMNS, "air_q_site_num", "weather_humidity", "_batch_id"]
    by_day, by_borough = (t.read(with_batch=True).select(*columns) for t in (catalog.integrated, catalog.by_borough))
    counts = difference_counts(by_borough, by_day)
    pruned = average_fare_in_area(by_borough, "ASIA")
    return pruned.select(
        counts.select("only_left").scalar().alias("only_left"),
        counts.select("only_right").scalar().alias("only_right"),
        "*",
    )


def _refreshed_product(spark, sf_dir, spec):
    table = _refreshed(spark, sf_dir, spec).product(spec.name)
    return roles.plain(p.read_product(table, spec).drop(*p.PROVENANCE))


def refreshed_zone_stats(spark, sf_dir):
    return _refreshed_product(spark, sf_dir, p.ZONE_STATISTICS)


def refreshed_weather(spark, sf_dir):
    return _refreshed_product(spark, sf_dir, p.WEATHER_SUMMARY)


def refreshed_air(spark, sf_dir):
    return _refreshed_product(spark, sf_dir, p.AIR_SUMMARY)


def refreshed_mobility(spark, sf_dir):
    return _refreshed_product(spark, sf_dir, p.MOBILITY_SUMMARY)


def corrected_air(spark, sf_dir):
    """Hourly air quality after a second station has reported for every hour that was summarised before."""
    catalog = _raw_catalog(spark, sf_dir, p.AIR_SUMMARY)
    air = catalog.table("air_quality").read()
    r.refresh(catalog)
    late = air.withColumns({"site_num": F.lit("late"), "sample_measurement": F.col("sample_measurement") + 20})
    catalog.table("air_quality").append(late)
    r.refresh(catalog)
    return roles.plain(p.read_product(catalog.product(p.AIR_SUMMARY.name), p.AIR_SUMMARY).drop(*p.PROVENANCE))


QUERIES = {
    f.__name__: f
    for f in (
        merge_new_keys,
        merge_into_table,
        append_novel_trips,
        update_records,
        evolve_schema_append,
        stream_update,
        read_asof,
        table_history,
        stored_state,
        detect_table_changes,
        products_to_refresh,
        refresh_late_station,
        reload_table,
        increment_integration,
        backfill_late_weather,
        backfill_late_air,
        product_merge_sum,
        mobility_merge_sum,
        refreshed_integrated,
        layouts_agree,
        refreshed_zone_stats,
        refreshed_weather,
        refreshed_air,
        refreshed_mobility,
        corrected_air,
    )
}

_NEW = f"""fresh AS ({one_per_key(NEW_LINES)}),
novel AS (SELECT * FROM fresh WHERE ({LINE_KEY}) NOT IN (SELECT ({LINE_KEY}) FROM {OLD_LINES}))"""
_NOVEL_TRIPS = f"""novel AS (SELECT DISTINCT * FROM trips WHERE {UPDATE}
  EXCEPT SELECT * FROM trips WHERE {HISTORY})"""
_BASE = with_(INTEGRATED)
_LINES = ", ".join(LINE_COLUMNS)
_CUT = f"TIMESTAMP '{roles.UPDATE_START}'"
_STATIONS = (
    f"""reported AS (SELECT * EXCLUDE (site_num) FROM air WHERE datetime_local < {_CUT})""",
    """stations AS (SELECT * FROM reported UNION ALL BY NAME SELECT * REPLACE (sample_measurement + 20 AS sample_measurement)
  FROM reported)""",
)
LATE_STATION = (
    with_(
        ROLES,
        *_STATIONS,
        """per_hour AS (SELECT county_name, datetime_local, ROUND(AVG(sample_measurement), 6) AS level, COUNT(*) AS n
  FROM stations WHERE state_code = '36' AND county_name IS NOT NULL GROUP BY 1, 2)""",
    )
    + f"""SELECT vendor_id, tpep_pickup_datetime, level AS air_q_sample_measurement, n AS air_q_measurements
FROM trips JOIN zones ON pu_location_id = location_id
JOIN per_hour ON borough = county_name AND date_trunc('hour', tpep_pickup_datetime) = datetime_local WHERE {HISTORY}"""
)
AIR_TEXT = """air_text AS (SELECT county_name, datetime_local, CASE WHEN MIN(site_num) = MAX(site_num) THEN MIN(site_num) END AS site_num,
    AVG(CAST(site_num AS INTEGER) * 2) AS aqi
  FROM air WHERE state_code = '36' AND county_name IS NOT NULL GROUP BY 1, 2)"""
_CORRECTED = f"""per_hour AS (SELECT county_name, datetime_local, {exact_mean('sample_measurement')} AS level
  FROM stations WHERE state_code = '36' AND county_name IS NOT NULL GROUP BY 1, 2),
corrected AS (SELECT integrated.* REPLACE (level AS air_q_sample_measurement)
  FROM integrated JOIN per_hour ON pu_borough = county_name AND weather_time = datetime_local WHERE {HISTORY})"""
RELOADED = (
    with_(ROLES)
    + f"""SELECT zone AS pu_zone, COUNT(*) AS taxi_demand FROM trips LEFT JOIN zones ON pu_location_id = location_id
WHERE {HISTORY} GROUP BY 1"""
)

ORACLES = {
    "merge_new_keys": with_(_NEW) + f"SELECT {_LINES} FROM novel",
    "merge_into_table": with_(_NEW)
    + f"""SELECT {_LINES}, CAST(NULL AS VARCHAR) AS l_note, CAST(0 AS INTEGER) AS _batch_id
FROM ({one_per_key(OLD_LINES)})
UNION ALL SELECT {_LINES}, l_returnflag, 1 FROM novel""",
    "append_novel_trips": with_(TRIPS, _NOVEL_TRIPS)
    + f"""SELECT *, CAST(0 AS INTEGER) AS _batch_id FROM trips WHERE {HISTORY} UNION ALL SELECT *, 1 FROM novel""",
    "update_records": with_(TRIPS, _NEW, _NOVEL_TRIPS.replace("novel", "novel_trips", 1))
    + f"""SELECT 'lines' AS dataset, n AS rows_in_update, CAST(0 AS BIGINT) AS null_keys, n - i AS duplicates,
  i AS inserted, '+l_note' AS schema_change
FROM (SELECT (SELECT COUNT(*) FROM {NEW_LINES}) AS n, (SELECT COUNT(*) FROM novel) AS i)
UNION ALL SELECT 'taxi_trips', n, 0, n - i, i, '' FROM (SELECT
  (SELECT COUNT(*) + COUNT(CASE WHEN trip_distance IS NULL THEN 1 END) FROM trips WHERE {UPDATE}) AS n,
  (SELECT COUNT(*) FROM novel_trips) AS i)""",
    "evolve_schema_append": with_(TRIPS)
    + f"""SELECT vendor_id, tpep_pickup_datetime, tip_amount, CAST(NULL AS DOUBLE) AS aqi FROM trips WHERE {HISTORY}
UNION ALL SELECT vendor_id, tpep_pickup_datetime, NULL, passenger_count FROM trips WHERE {UPDATE}""",
    "stream_update": with_(TRIPS, _NOVEL_TRIPS)
    + f"SELECT * FROM trips WHERE {HISTORY} UNION ALL SELECT * FROM novel",
    "read_asof": """SELECT *, CASE WHEN o_orderstatus = 'P' THEN 'since' ELSE 'as_of' END AS part
FROM orders WHERE o_orderstatus IN ('O', 'F', 'P')""",
    "table_history": """SELECT CAST(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS INTEGER) AS _batch_id,
  COUNT(*) AS row_count, TRUE AS committed FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1""",
    "stored_state": with_(ROLES)
    + f"""SELECT t AS table_name, CAST(0 AS INTEGER) AS version, CAST(c AS INTEGER) AS column_count, n AS row_count FROM (
  SELECT 'trips' AS t, 19 AS c, COUNT(*) AS n FROM trips WHERE {HISTORY}
  UNION ALL SELECT 'weather', 8, COUNT(*) FROM weather WHERE timestamp < {_CUT}
  UNION ALL SELECT 'zones', 4, COUNT(*) FROM zones
  UNION ALL SELECT 'air_quality', 5, COUNT(*) FROM air WHERE datetime_local < {_CUT})""",
    "detect_table_changes": with_(ROLES, _NOVEL_TRIPS)
    + f"""SELECT t AS table_name, CAST(0 AS INTEGER) AS old_version, CAST(v AS INTEGER) AS new_version, a AS added,
  '' AS removed, '' AS retyped, CASE v WHEN 1 THEN 'changed' ELSE 'same' END AS status, n AS new_rows FROM (
  SELECT 'trips' AS t, 1 AS v, '' AS a, COUNT(*) AS n FROM novel
  UNION ALL SELECT 'weather', 1, 'humidity', COUNT(*) FROM weather WHERE timestamp >= {_CUT}
  UNION ALL SELECT 'zones', 0, '', 0
  UNION ALL SELECT 'air_quality', 1, '', COUNT(*) FROM air WHERE datetime_local >= {_CUT})""",
    "products_to_refresh": with_(ROLES)
    + f"SELECT 'weather_impact_summary' AS product, COUNT(*) AS n_new FROM weather WHERE timestamp >= {_CUT}",
    "refresh_late_station": LATE_STATION,
    "reload_table": RELOADED,
    "increment_integration": with_(
        ROLES,
        f"""early_weather AS (SELECT * FROM weather WHERE timestamp < {_CUT})""",
        f"""early_air AS (SELECT * FROM air_one WHERE datetime_local < {_CUT})""",
    )
    + f"""SELECT vendor_id, tpep_pickup_datetime, w.prcp AS weather_prcp, w.timestamp IS NOT NULL AS weather_matched,
  pz.zone AS pu_zone, dz.zone AS do_zone, a.sample_measurement AS air_q_sample_measurement,
  CAST(CASE WHEN {HISTORY} THEN 0 ELSE 1 END AS INTEGER) AS _batch_id
FROM trips t LEFT JOIN early_weather w ON date_trunc('hour', tpep_pickup_datetime) = w.timestamp
LEFT JOIN zones pz ON pu_location_id = pz.location_id LEFT JOIN zones dz ON do_location_id = dz.location_id
LEFT JOIN early_air a ON pz.borough = a.county_name AND date_trunc('hour', tpep_pickup_datetime) = a.datetime_local""",
    "backfill_late_weather": with_(INTEGRATED)
    + """SELECT vendor_id, tpep_pickup_datetime, weather_matched, weather_temp, weather_prcp,
  CASE WHEN hour(tpep_pickup_datetime) >= 12 THEN weather_rhum + 1 END AS weather_humidity, pu_zone FROM integrated""",
    "backfill_late_air": with_(INTEGRATED, AIR_TEXT)
    + f"""SELECT vendor_id, tpep_pickup_datetime, pu_borough, air_q_matched, air_q_sample_measurement,
  air_q_measurements, site_num AS air_q_site_num, CASE WHEN weather_time >= {_CUT} THEN aqi END AS air_q_aqi
FROM integrated LEFT JOIN air_text ON pu_borough = county_name AND weather_time = datetime_local""",
    "layouts_agree": _BASE
    + f"""SELECT CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right, pu_borough,
  {half_up(exact_mean('fare_amount'), 4)} AS avg_fare FROM integrated WHERE pu_borough = 'ASIA' GROUP BY pu_borough""",
    "corrected_air": with_(INTEGRATED, *_STATIONS, _CORRECTED) + AIR_SQL.replace("FROM integrated", "FROM corrected"),
    "product_merge_sum": _BASE + ZONE_SQL,
    "mobility_merge_sum": _BASE + MOBILITY_SQL,
    "refreshed_integrated": _BASE + f"SELECT {', '.join(INTEGRATED_COLUMNS)} FROM integrated",
    "refreshed_zone_stats": _BASE + ZONE_SQL,
    "refreshed_weather": _BASE + WEATHER_SQL,
    "refreshed_air": whole_means(_BASE) + AIR_SQL,
    "refreshed_mobility": _BASE + MOBILITY_SQL,
}
