"""Building update data, on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from farebox.functions.measures import clipped_index
from farebox.functions.timeparts import shift_hours
from farebox.operators import augment as a
from farebox.registry import roles
from farebox.registry.sql import AIR, EV, TRIPS, WEATHER, ZONES, half_up, with_
from farebox.sources.readers import read_csv_text, write_csv, write_parquet
from farebox.sources.scratch import scratch_path

SEED = 42


def _events(spark, sf_dir):
    return roles.events(spark, sf_dir).select("event_id", "ts", "user_id", "value", "k")


def sample_exact_n(spark, sf_dir):
    """Exactly 1.5 % of the events, the same ones every time."""
    events = _events(spark, sf_dir)
    return roles.plain(a.sample_exact(events, a.quota(events, 0.015), SEED, ["event_id"]))


def sample_replacement(spark, sf_dir):
    """As many events as make up 7 %, some more than once."""
    events = _events(spark, sf_dir)
    return roles.plain(a.sample_with_replacement(events, a.quota(events, 0.07), SEED, ["event_id"]))


def duplicate_injection(spark, sf_dir):
    """All events plus exact copies of 1.5 % of them."""
    events = _events(spark, sf_dir)
    copies = a.sample_exact(events, a.quota(events, 0.015), SEED + 1, ["event_id"])
    return roles.plain(a.inject_duplicates(events, copies))


def time_shift(spark, sf_dir):
    """Trips moved 1 to 31 days past the latest pickup; durations stay."""
    trips = roles.trips(spark, sf_dir).select("vendor_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "fare_amount")
    seconds = F.lit(86400) + (F.col("vendor_id") * 7919) % (30 * 86400)
    return roles.plain(a.shift_past_latest(trips, "tpep_pickup_datetime", "tpep_dropoff_datetime", seconds))


PARTS = [
    *["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount"],
    *["improvement_surcharge", "congestion_surcharge", "airport_fee"],
]


def recompute_total(spark, sf_dir):
    trips = roles.trips(spark, sf_dir).select("vendor_id", "tpep_pickup_datetime", *PARTS)
    return roles.plain(a.recompute_total(trips, PARTS, "total_amount"))


def tail_window_stats(spark, sf_dir):
    """Mean and deviation over the last 168 hours of weather."""
    stats = a.tail_statistics(roles.weather(spark, sf_dir), [F.desc("timestamp")], 168, ["temp", "rhum", "prcp"])
    return stats.select("measure", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def hourly_spine(spark, sf_dir):
    """The 240 hours after the last weather observation."""
    return roles.plain(a.hourly_spine(roles.weather(spark, sf_dir), "timestamp", 240))


STATION = ["state_code", "county_name", "site_num"]


def station_grid(spark, sf_dir):
    """Twenty stations, three days of hours after the last measurement, local and GMT time."""
    air = roles.air_quality(spark, sf_dir)
    last = air.agg(F.date_trunc("day", F.max("datetime_local"))).scalar()
    first = last + F.make_dt_interval(F.lit(1))
    grid = a.station_grid(a.stations(air, STATION, 20), first, 72, "local_time")
    return roles.plain(grid.withColumn("gmt_time", shift_hours(F.col("local_time"), 5)))


def gmt_shift(spark, sf_dir):
    """Local measurement time as GMT date and time texts; the day rolls over."""
    gmt = shift_hours(F.col("datetime_local"), 5)
    return roles.plain(roles.air_quality(spark, sf_dir)).select(
        "state_code",
        "site_num",
        "datetime_local",
        F.date_format(gmt, "yyyy-MM-dd").alias("date_gmt"),
        F.date_format(gmt, "HH:mm").alias("time_gmt"),
    )


def index_clip(spark, sf_dir):
    """Index from a measurement, rounded half to even and clipped to 0..500."""
    return _events(spark, sf_dir).select(
        "event_id",
        clipped_index(F.col("value"), 4.0, 0, 500).alias("aqi"),
        clipped_index(F.col("k") / 8.0, 4.0, 0, 500).alias("half_aqi"),
    )


def key_defaults(spark, sf_dir):
    poc = F.nullif(F.col("k") % 4, F.lit(3)).alias("poc")
    return a.fill_defaults(_events(spark, sf_dir).select("event_id", poc), {"poc": 1})


def latest_from_csv(spark, sf_dir):
    """Rows of the last day of a CSV file, with the rows the file has in all."""
    path = scratch_path(spark, "events-csv")
    day = F.date_format("ts", "yyyy-MM-dd").alias("Date Local")
    write_csv(_events(spark, sf_dir).select("event_id", day, "value"), path)
    text = read_csv_text(spark, path)
    typed = text.select(
        F.col("event_id").try_cast("bigint").alias("event_id"),
        F.col("Date Local").try_cast("date").alias("date_local"),
        F.col("value").try_cast("double").alias("value"),
    )
    return a.latest_rows(typed, "date_local").withColumn("file_rows", text.agg(F.count("*")).scalar())


def update_file(spark, sf_dir):
    """An update file written as Parquet and read back."""
    path = scratch_path(spark, "update-file")
    _, update = roles.split_trips(spark, sf_dir)
    write_parquet(update.select("vendor_id", "tpep_pickup_datetime", "trip_distance"), path)
    return roles.plain(spark.read.parquet(path))


QUERIES = {
    f.__name__: f
    for f in (
        sample_exact_n,
        sample_replacement,
        duplicate_injection,
        time_shift,
        recompute_total,
        tail_window_stats,
        hourly_spine,
        station_grid,
        gmt_shift,
        index_clip,
        key_defaults,
        latest_from_csv,
        update_file,
    )
}


def _drawn(seed: int) -> str:
    return f"""(SELECT event_id, ts, user_id, value, k FROM ev
  ORDER BY md5('{seed}|' || event_id) LIMIT (SELECT CAST(ceil(COUNT(*) * 0.015) AS BIGINT) FROM events))"""


ORACLES = {
    "sample_exact_n": with_(EV) + f"SELECT * FROM {_drawn(SEED)}",
    "sample_replacement": with_(
        EV,
        f"""placed AS (SELECT event_id, ts, user_id, value, k,
    row_number() OVER (ORDER BY md5('{SEED}|' || event_id)) - 1 AS place, COUNT(*) OVER () AS n FROM ev)""",
        f"""draws AS (SELECT CAST('0x' || substr(md5('{SEED}|' || i), 1, 15) AS BIGINT) AS d
    FROM range((SELECT CAST(ceil(COUNT(*) * 0.07) AS BIGINT) FROM ev)) AS r(i))""",
    )
    + "SELECT event_id, ts, user_id, value, k FROM draws JOIN placed ON place = d % (SELECT COUNT(*) FROM ev)",
    "duplicate_injection": with_(EV)
    + f"SELECT event_id, ts, user_id, value, k FROM ev UNION ALL SELECT * FROM {_drawn(SEED + 1)}",
    "time_shift": with_(TRIPS, "latest AS (SELECT MAX(tpep_pickup_datetime) AS t FROM trips)")
    + """SELECT vendor_id, p AS tpep_pickup_datetime,
  p + (tpep_dropoff_datetime - tpep_pickup_datetime) AS tpep_dropoff_datetime, fare_amount
FROM (SELECT *, (SELECT t FROM latest) + to_seconds(86400 + (vendor_id * 7919) % (30 * 86400)) AS p FROM trips)""",
    "recompute_total": with_(TRIPS)
    + f"""SELECT vendor_id, tpep_pickup_datetime, {', '.join(PARTS)}, CAST(ROUND({
        ' + '.join(f'CAST(COALESCE({c}, 0) AS DECIMAL(18,4))' for c in PARTS)}, 2) AS DOUBLE) AS total_amount FROM trips""",
    "tail_window_stats": with_(EV, WEATHER, "tail AS (SELECT * FROM weather ORDER BY timestamp DESC LIMIT 168)")
    + " UNION ALL ".join(
        f"SELECT '{m}' AS measure, {half_up(f'AVG({m})', 6)} AS mean, {half_up(f'STDDEV_SAMP({m})', 6)} AS std FROM tail"
        for m in ("temp", "rhum", "prcp")
    ),
    "hourly_spine": """SELECT timestamp, CAST(year(timestamp) AS INTEGER) AS year,
  CAST(month(timestamp) AS INTEGER) AS month, CAST(day(timestamp) AS INTEGER) AS day,
  CAST(hour(timestamp) AS INTEGER) AS hour
FROM (SELECT date_trunc('hour', MAX(ts)) + to_hours(CAST(i AS INTEGER)) AS timestamp
  FROM events, range(1, 241) AS r(i) WHERE event_type = 'error' GROUP BY i)""",
    "station_grid": with_(
        EV,
        ZONES,
        AIR,
        f"stations AS (SELECT DISTINCT {', '.join(STATION)} FROM air ORDER BY ALL NULLS LAST LIMIT 20)",
        "last AS (SELECT date_trunc('day', MAX(datetime_local)) AS t FROM air)",
    )
    + f"""SELECT {', '.join(STATION)}, t + to_hours(CAST(24 + i AS INTEGER)) AS local_time,
  t + to_hours(CAST(29 + i AS INTEGER)) AS gmt_time FROM stations, last, range(72) AS r(i)""",
    "gmt_shift": with_(EV, ZONES, AIR)
    + """SELECT state_code, site_num, datetime_local, strftime(datetime_local + INTERVAL 5 HOUR, '%Y-%m-%d') AS date_gmt,
  strftime(datetime_local + INTERVAL 5 HOUR, '%H:%M') AS time_gmt FROM air""",
    "index_clip": with_(EV)
    + """SELECT event_id, CAST(LEAST(GREATEST(round_even(value * 4, 0), 0), 500) AS INTEGER) AS aqi,
  CAST(LEAST(GREATEST(round_even(k / 8.0 * 4, 0), 0), 500) AS INTEGER) AS half_aqi FROM ev""",
    "key_defaults": with_(EV) + "SELECT event_id, CASE WHEN k % 4 = 3 THEN 1 ELSE k % 4 END AS poc FROM ev",
    "latest_from_csv": """SELECT event_id, CAST(ts AS DATE) AS date_local, value,
  (SELECT COUNT(*) FROM events) AS file_rows
FROM events WHERE CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events)""",
    "update_file": with_(TRIPS)
    + f"""SELECT vendor_id, tpep_pickup_datetime, trip_distance FROM trips
WHERE tpep_pickup_datetime >= TIMESTAMP '{roles.UPDATE_START}'""",
}
