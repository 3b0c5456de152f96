"""Joins on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from farebox.functions import measures
from farebox.operators.joins import hour_join, key_overlap
from farebox.operators.rowsets import (
    difference_counts,
    multiset_difference,
    novel_rows,
    snapshot_diff,
    union_all,
)
from farebox.operators.summaries import is_wet, zone_monthly_demand
from farebox.plans import integrate as wide
from farebox.registry import roles
from farebox.registry.sql import (
    HISTORY,
    INTEGRATED,
    LINE_KEY,
    NEW_LINES,
    OLD_LINES,
    ROLES,
    TRIPS,
    UPDATE,
    WEATHER,
    ZONES,
    exact_mean,
    half_up,
    mean,
    with_,
)
from farebox.registry.sql import wide as wide_sql
from farebox.sources.scratch import scratch_path, stage
from farebox.sources.tables import Table

TRIP = ["vendor_id", "tpep_pickup_datetime", "trip_distance", "fare_amount"]
SQL_TRIP = ", ".join(f"t.{c}" for c in TRIP)


def integrated_frame(spark, sf_dir, per_trip="one"):
    return wide.integrate(
        roles.trips(spark, sf_dir),
        roles.weather(spark, sf_dir),
        roles.zones(spark, sf_dir),
        roles.air_quality(spark, sf_dir),
        per_trip,
    )


def enrich_hourly_weather(spark, sf_dir):
    joined = wide.with_weather(roles.trips(spark, sf_dir), roles.weather(spark, sf_dir))
    return roles.plain(joined.select(*TRIP, "weather_time", "weather_matched", "weather_temp", "weather_prcp"))


def enrich_zones_both_ends(spark, sf_dir):
    joined = wide.with_zones(roles.trips(spark, sf_dir), roles.zones(spark, sf_dir))
    return roles.plain(joined.select(*TRIP, "pu_borough", "pu_zone", "do_borough", "do_zone"))


def enrich_air_one(spark, sf_dir):
    """All air-quality columns on the trip grain, each summarised over the stations of its hour by its type."""
    station = F.col("site_num").cast("int")
    air = roles.air_quality(spark, sf_dir).withColumns(
        {
            "aqi": station * 3,
            "mdl": F.when(station % 4 != 0, station / 4),
            "units": F.when(station % 2 == 0, "ug").otherwise("ppm"),
            "valid": station % 3 == 0,
            "date_of_change": F.col("datetime_local") + F.make_dt_interval(station),
        }
    )
    trips, zones = roles.trips(spark, sf_dir), roles.zones(spark, sf_dir)
    placed = wide.with_air(wide.with_zones(wide.with_hour(trips), zones, ["pu"]), wide.staged_air(air))
    names = ["state_code", "site_num", "sample_measurement", "aqi", "mdl", "units", "valid", "date_of_change"]
    columns = ["pu_borough", "air_q_matched", *[f"air_q_{n}" for n in names], "air_q_measurements"]
    return roles.plain(placed.select(*TRIP, *columns))


def enrich_air_many(spark, sf_dir):
    columns = ["pu_borough", "air_q_matched", "air_q_sample_measurement", "air_q_site_num"]
    return roles.plain(integrated_frame(spark, sf_dir, "many").select(*TRIP, *columns))


def station_weighted_demand(spark, sf_dir):
    """Zone demand as the ``many`` form counts it, from the trip-grain table."""
    weight = wide.station_rows()
    return roles.plain(zone_monthly_demand(integrated_frame(spark, sf_dir), weight=weight))


INTEGRATED_COLUMNS = [
    *["vendor_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "pu_location_id", "do_location_id"],
    *["trip_distance", "fare_amount", "store_and_fwd_flag", "weather_time", "weather_temp", "weather_rhum"],
    *["weather_prcp", "weather_matched", "pu_borough", "pu_zone", "do_borough", "do_zone", "air_q_matched"],
    *["air_q_sample_measurement", "air_q_measurements", "day_timestamp"],
]


def integrated(spark, sf_dir):
    return roles.plain(integrated_frame(spark, sf_dir).select(*INTEGRATED_COLUMNS))


def _distance_by_rain(spark, sf_dir, hint):
    joined = hour_join(
        roles.trips(spark, sf_dir).select("tpep_pickup_datetime", "trip_distance"),
        roles.weather(spark, sf_dir).select("timestamp", "prcp"),
        *("tpep_pickup_datetime", "timestamp", "weather_", "weather_time"),
        how="inner",
        hint=hint,
    )
    known = joined.dropna(subset=["weather_prcp"])
    average = measures.shown(measures.mean(F.col("trip_distance")), 2).alias("avg_trip_distance")
    return known.groupBy(is_wet("weather_prcp").alias("is_raining")).agg(average)


def join_broadcast(spark, sf_dir):
    """Inner hour join with the stored dimension broadcast, if its size allows."""
    return _distance_by_rain(spark, sf_dir, "broadcast")


def join_shuffle(spark, sf_dir):
    """The same with both sides shuffled and merged."""
    return _distance_by_rain(spark, sf_dir, "merge")


def key_overlap_counts(spark, sf_dir):
    old, new = roles.split_lines(spark, sf_dir)
    return key_overlap(new, old, ["l_orderkey", "l_linenumber"])


def novel_rows_nullsafe(spark, sf_dir):
    """Trips of the update that history does not have; several columns hold NULLs."""
    history, update = roles.split_trips(spark, sf_dir)
    copies = update.unionByName(update.filter(F.col("trip_distance").isNull()))
    return roles.plain(novel_rows(stage(copies, "update"), history, "tpep_pickup_datetime"))


def union_by_name(spark, sf_dir):
    """Two overlapping parts as one table, copies kept."""
    return roles.plain(union_all(roles.split_lines(spark, sf_dir)))


def except_all(spark, sf_dir):
    """Part and supplier pairs of the new lines, less those of the old, copy by copy."""
    old, new = roles.split_lines(spark, sf_dir)
    names = ["l_suppkey", "l_returnflag", "l_linestatus"]
    return multiset_difference(old.select(*names), new.select(*names))


def equivalence_counts(spark, sf_dir):
    """How many rows each of two overlapping parts has beyond the other."""
    old, new = roles.split_lines(spark, sf_dir)
    return difference_counts(old, new)


def snapshot_difference(spark, sf_dir):
    """New rows of a table that also gained a column, against its earlier snapshot."""
    history, update = roles.split_trips(spark, sf_dir)
    names = ["vendor_id", "tpep_pickup_datetime", "trip_distance", "tolls_amount"]
    aqi = F.col("passenger_count").alias("aqi")
    current = history.select(*names, aqi).union(update.select(*names, aqi)).dropDuplicates()
    return roles.plain(snapshot_diff(current, history.select(*names)))


def partitioned_roundtrip(spark, sf_dir):
    """Trips stored by borough in two batches and read back; unmatched trips keep their NULL borough."""
    trips = wide.with_zones(roles.trips(spark, sf_dir), roles.zones(spark, sf_dir))
    history, update = roles.split(trips, "tpep_pickup_datetime", roles.HISTORY_END, roles.HISTORY_END)
    table = Table(spark, scratch_path(spark, "by-borough"), {"pu_borough": trips.schema["pu_borough"].dataType})
    table.append(history.drop("tip_amount"))
    table.append(update)
    return roles.plain(table.read(with_batch=True).select(*TRIP, "tip_amount", "pu_borough", "_batch_id"))


QUERIES = {
    f.__name__: f
    for f in (
        enrich_hourly_weather,
        enrich_zones_both_ends,
        enrich_air_one,
        enrich_air_many,
        station_weighted_demand,
        integrated,
        join_broadcast,
        join_shuffle,
        key_overlap_counts,
        novel_rows_nullsafe,
        union_by_name,
        except_all,
        equivalence_counts,
        snapshot_difference,
        partitioned_roundtrip,
    )
}

_BY_RAIN = with_(TRIPS, WEATHER) + f"""SELECT prcp <> 0 AS is_raining,
  {half_up(exact_mean('trip_distance'), 2)} AS avg_trip_distance
FROM trips JOIN weather ON date_trunc('hour', tpep_pickup_datetime) = timestamp WHERE prcp IS NOT NULL GROUP BY 1"""

_PAIRS = "l_suppkey, l_returnflag, l_linestatus"

_AIR_COLUMNS = f"""air_columns AS (SELECT county_name, datetime_local, MIN(state_code) AS state_code,
    CASE WHEN MIN(site_num) = MAX(site_num) THEN MIN(site_num) END AS site_num, {mean('sample_measurement')} AS sample_measurement,
    AVG(s * 3) AS aqi, AVG(CASE WHEN s % 4 <> 0 THEN s / 4 END) AS mdl,
    CASE WHEN bool_and(s % 2 = 0) THEN 'ug' WHEN bool_and(s % 2 <> 0) THEN 'ppm' END AS units, bool_or(s % 3 = 0) AS valid,
    MAX(datetime_local + to_days(s)) AS date_of_change, COUNT(*) AS measurements
  FROM (SELECT *, CAST(site_num AS INTEGER) AS s FROM air WHERE state_code = '36' AND county_name IS NOT NULL) GROUP BY 1, 2)"""

ORACLES = {
    "enrich_hourly_weather": with_(TRIPS, WEATHER)
    + f"""SELECT {SQL_TRIP}, date_trunc('hour', t.tpep_pickup_datetime) AS weather_time,
  w.timestamp IS NOT NULL AS weather_matched, temp AS weather_temp, prcp AS weather_prcp
FROM trips t LEFT JOIN weather w ON date_trunc('hour', t.tpep_pickup_datetime) = w.timestamp""",
    "enrich_zones_both_ends": with_(TRIPS, ZONES)
    + f"""SELECT {SQL_TRIP}, p.borough AS pu_borough, p.zone AS pu_zone, d.borough AS do_borough, d.zone AS do_zone
FROM trips t LEFT JOIN zones p ON pu_location_id = p.location_id LEFT JOIN zones d ON do_location_id = d.location_id""",
    "enrich_air_one": with_(ROLES, _AIR_COLUMNS)
    + f"""SELECT {SQL_TRIP}, p.borough AS pu_borough, a.datetime_local IS NOT NULL AS air_q_matched,
  a.state_code AS air_q_state_code, a.site_num AS air_q_site_num, a.sample_measurement AS air_q_sample_measurement,
  a.aqi AS air_q_aqi, a.mdl AS air_q_mdl, a.units AS air_q_units, a.valid AS air_q_valid,
  a.date_of_change AS air_q_date_of_change, a.measurements AS air_q_measurements
FROM trips t LEFT JOIN zones p ON pu_location_id = p.location_id
LEFT JOIN air_columns a ON p.borough = a.county_name AND date_trunc('hour', t.tpep_pickup_datetime) = a.datetime_local""",
    "enrich_air_many": with_(ROLES)
    + f"""SELECT {SQL_TRIP}, p.borough AS pu_borough, a.site_num IS NOT NULL AS air_q_matched,
  a.sample_measurement AS air_q_sample_measurement, a.site_num AS air_q_site_num
FROM trips t LEFT JOIN zones p ON pu_location_id = p.location_id
LEFT JOIN (SELECT * FROM air WHERE state_code = '36') a
  ON p.borough = a.county_name AND date_trunc('hour', t.tpep_pickup_datetime) = a.datetime_local""",
    "station_weighted_demand": with_(ROLES, f"station_grain AS ({wide_sql(air='air')})")
    + """SELECT pu_zone, CAST(date_trunc('month', tpep_pickup_datetime) AS TIMESTAMP) AS month, COUNT(*) AS count
FROM station_grain GROUP BY 1, 2""",
    "integrated": with_(INTEGRATED) + f"SELECT {', '.join(INTEGRATED_COLUMNS)} FROM integrated",
    "join_broadcast": _BY_RAIN,
    "join_shuffle": _BY_RAIN,
    "key_overlap_counts": f"""WITH o AS (SELECT {LINE_KEY}, COUNT(*) AS n FROM {OLD_LINES} GROUP BY ALL)
SELECT COUNT(*) AS update_rows, COUNT(o.n) AS matched_rows, CAST(SUM(o.n) AS BIGINT) AS matched_pairs
FROM {NEW_LINES} u LEFT JOIN o USING ({LINE_KEY})""",
    "novel_rows_nullsafe": with_(TRIPS)
    + f"SELECT DISTINCT * FROM trips WHERE {UPDATE} EXCEPT SELECT * FROM trips WHERE {HISTORY}",
    "union_by_name": f"SELECT * FROM {OLD_LINES} UNION ALL SELECT * FROM {NEW_LINES}",
    "except_all": f"SELECT {_PAIRS} FROM {OLD_LINES} EXCEPT ALL SELECT {_PAIRS} FROM {NEW_LINES}",
    "equivalence_counts": f"""SELECT
  (SELECT COUNT(*) FROM (SELECT * FROM {OLD_LINES} EXCEPT ALL SELECT * FROM {NEW_LINES})) AS only_left,
  (SELECT COUNT(*) FROM (SELECT * FROM {NEW_LINES} EXCEPT ALL SELECT * FROM {OLD_LINES})) AS only_right""",
    "snapshot_difference": with_(TRIPS)
    + f"""SELECT DISTINCT vendor_id, tpep_pickup_datetime, trip_distance, tolls_amount, passenger_count AS aqi
FROM trips t WHERE {UPDATE} AND NOT EXISTS (SELECT 1 FROM trips h
  WHERE h.{HISTORY} AND h.vendor_id = t.vendor_id AND h.tpep_pickup_datetime = t.tpep_pickup_datetime
    AND h.trip_distance IS NOT DISTINCT FROM t.trip_distance AND h.tolls_amount IS NOT DISTINCT FROM t.tolls_amount)""",
    "partitioned_roundtrip": with_(TRIPS, ZONES)
    + f"""SELECT {SQL_TRIP}, CASE WHEN NOT {HISTORY} THEN tip_amount END AS tip_amount, p.borough AS pu_borough,
  CAST(CASE WHEN {HISTORY} THEN 0 ELSE 1 END AS INTEGER) AS _batch_id
FROM trips t LEFT JOIN zones p ON pu_location_id = p.location_id""",
}
