"""Quality checks and ingestion on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from farebox.operators import quality as q
from farebox.plans.ingest import ingest_dataset, ingest_frame, ingest_log
from farebox.registry import roles
from farebox.registry.sql import EV, LINE_KEY, TRIPS, WEATHER, NEW_LINES, one_per_key, with_
from farebox.sources.city import WEATHER_MEASURES, trips_spec, weather_spec
from farebox.sources.readers import write_csv
from farebox.sources.scratch import scratch_path
from farebox.sources.tables import Table

KEY = ["l_orderkey", "l_linenumber"]


def dq_primary_key(spark, sf_dir):
    """Complete keys only, one row per key."""
    lines = roles.table(spark, sf_dir, "lineitem")
    gapped = lines.withColumn("l_orderkey", F.nullif(F.col("l_orderkey"), F.lit(1)))
    return roles.plain(q.quality_gate(gapped, KEY))


def dq_full_row(spark, sf_dir):
    """Exact copies removed from a table that holds its newest rows twice."""
    lines = roles.table(spark, sf_dir, "lineitem")
    _, newest = roles.split_lines(spark, sf_dir)
    return roles.plain(q.quality_gate(lines.unionByName(newest), []))


def dq_metrics(spark, sf_dir):
    lines = roles.table(spark, sf_dir, "lineitem")
    return q.quality_counts(lines.withColumn("l_orderkey", F.nullif(F.col("l_orderkey"), F.lit(1))), KEY)


def _raw_weather(spark, sf_dir):
    """The hourly weather as its CSV file: all declared columns, the first week delivered twice."""
    hours = roles.weather(spark, sf_dir)
    have = {"temp", "rhum", "prcp"}
    columns = [F.col(p) for p in ("year", "month", "day", "hour")]
    for m in WEATHER_MEASURES:
        columns += [F.col(m) if m in have else F.lit(None).cast("double").alias(m), F.lit(" obs ").alias(f"{m}_source")]
    file = hours.select(*columns)
    path = scratch_path(spark, "weather-csv")
    write_csv(file.unionByName(file.filter(F.col("day") <= 7)), path)
    return weather_spec(path)


def _ingest_weather(spark, sf_dir):
    table = Table(spark, scratch_path(spark, "weather-table"))
    return table, ingest_dataset(spark, _raw_weather(spark, sf_dir), table)


def ingest_weather_csv(spark, sf_dir):
    table, _ = _ingest_weather(spark, sf_dir)
    return roles.plain(
        table.read().select("year", "month", "day", "hour", "temp", "rhum", "prcp", "snwd", "prcp_source", "timestamp")
    )


def _ingest_trips(spark, sf_dir):
    raw = roles.raw_trips(spark, sf_dir)
    again = raw.filter(F.col("tpep_pickup_datetime") >= F.lit(roles.UPDATE_START).cast("timestamp"))
    table = Table(spark, scratch_path(spark, "trips-table"))
    return table, ingest_frame(raw.unionByName(again), trips_spec(), table)


def ingest_trip_file(spark, sf_dir):
    table, _ = _ingest_trips(spark, sf_dir)
    return roles.plain(table.read())


def ingest_records(spark, sf_dir):
    """The load log, without its time and schema hash."""
    _, weather = _ingest_weather(spark, sf_dir)
    _, trips = _ingest_trips(spark, sf_dir)
    return ingest_log(spark, [weather, trips]).drop("execution_time_seconds", "schema_version")


QUERIES = {
    f.__name__: f
    for f in (dq_primary_key, dq_full_row, dq_metrics, ingest_weather_csv, ingest_trip_file, ingest_records)
}

_GAPPED = "(SELECT * REPLACE (NULLIF(l_orderkey, 1) AS l_orderkey) FROM lineitem)"

ORACLES = {
    "dq_primary_key": f"SELECT * FROM ({one_per_key(_GAPPED)}) WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL",
    "dq_full_row": f"SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM {NEW_LINES})",
    "dq_metrics": f"""SELECT CAST(COUNT(*) AS BIGINT) AS processed, COUNT(*) - COUNT(l_orderkey) AS null_key,
  COUNT(l_orderkey) - COUNT(DISTINCT CASE WHEN l_orderkey IS NOT NULL THEN ({LINE_KEY}) END) AS duplicate,
  COUNT(DISTINCT CASE WHEN l_orderkey IS NOT NULL THEN ({LINE_KEY}) END) AS kept FROM {_GAPPED}""",
    "ingest_weather_csv": with_(EV, WEATHER)
    + """SELECT year, month, day, hour, temp, rhum, prcp, CAST(NULL AS DOUBLE) AS snwd, 'obs' AS prcp_source,
  timestamp FROM weather""",
    "ingest_trip_file": with_(TRIPS) + "SELECT DISTINCT * FROM trips",
    "ingest_records": with_(TRIPS, WEATHER)
    + f"""SELECT 'weather' AS dataset, COUNT(*) + COUNT(CASE WHEN day <= 7 THEN 1 END) AS processed_records,
  COUNT(CASE WHEN day <= 7 THEN 1 END) AS rejected_records, CAST(0 AS BIGINT) AS null_key_records,
  COUNT(CASE WHEN day <= 7 THEN 1 END) AS duplicate_records, COUNT(*) AS final_records FROM weather
UNION ALL SELECT 'taxi_trips_01', n + again, n + again - kept, 0, n + again - kept, kept FROM (
  SELECT COUNT(*) AS n, COUNT(CASE WHEN tpep_pickup_datetime >= TIMESTAMP '{roles.UPDATE_START}' THEN 1 END) AS again,
    (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM trips)) AS kept FROM trips)""",
}
