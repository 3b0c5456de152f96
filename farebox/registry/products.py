"""Stored summaries on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from farebox.operators import summaries as s
from farebox.plans import products as p
from farebox.registry import roles
from farebox.registry.analytics import aired, pickup_zoned, weathered
from farebox.registry.sql import INTEGRATED, exact_mean, exact_total, half_up, mean, whole_means, with_
from farebox.sources.scratch import scratch_path
from farebox.sources.tables import Table

_SOURCE = "integrated_by_date"


# Each product is built from trips with only the dimension it needs.
_BASES = {
    p.ZONE_STATISTICS.name: pickup_zoned,
    p.WEATHER_SUMMARY.name: weathered,
    p.AIR_SUMMARY.name: aired,
    p.MOBILITY_SUMMARY.name: roles.trips,
}


def _stored(spark, sf_dir, spec) -> Table:
    table = Table(spark, scratch_path(spark, spec.name))
    p.store_product(table, p.product_state(_BASES[spec.name](spark, sf_dir), spec), spec, _SOURCE)
    return table


def _shown(spark, sf_dir, spec):
    return p.read_product(_stored(spark, sf_dir, spec), spec).drop(*p.PROVENANCE)


def product_zone_stats(spark, sf_dir):
    return roles.plain(_shown(spark, sf_dir, p.ZONE_STATISTICS))


def product_weather(spark, sf_dir):
    return _shown(spark, sf_dir, p.WEATHER_SUMMARY)


def product_air(spark, sf_dir):
    return roles.plain(_shown(spark, sf_dir, p.AIR_SUMMARY))


def product_mobility(spark, sf_dir):
    return _shown(spark, sf_dir, p.MOBILITY_SUMMARY).orderBy("day_of_week", "pickup_hour")


def product_provenance(spark, sf_dir):
    """Provenance after a second refresh: creation time kept, version raised, demand unchanged."""
    spec = p.MOBILITY_SUMMARY
    table = _stored(spark, sf_dir, spec)
    first, _ = p.provenance_of(table)
    p.store_product(table, p.day_states(table).read(), spec, _SOURCE)
    shown = p.read_product(table, spec)
    made = F.lit(first)
    return shown.groupBy("data_source", "schema_version").agg(
        F.bool_and((F.col("creation_time") == made) & (F.col("refresh_time") > made)).alias("times_ok"),
        F.sum("taxi_demand").alias("taxi_demand"),
    )


def product_zone_demand(spark, sf_dir):
    return roles.plain(s.product_zone_demand(_shown(spark, sf_dir, p.ZONE_STATISTICS)))


def product_rain_distance(spark, sf_dir):
    return s.product_rain_distance(_shown(spark, sf_dir, p.WEATHER_SUMMARY))


def product_hourly_air(spark, sf_dir):
    return roles.plain(s.product_hourly_air(_shown(spark, sf_dir, p.AIR_SUMMARY)))


def product_air_correlation(spark, sf_dir):
    hourly = s.product_hourly_air(_shown(spark, sf_dir, p.AIR_SUMMARY))
    return s.correlation_of(hourly, "taxi_demand", "avg_air_quality").select(
        F.round("correlation", 6).alias("correlation")
    )


def product_peak_hour(spark, sf_dir):
    return s.product_peak_hour(_shown(spark, sf_dir, p.MOBILITY_SUMMARY))


def product_monthly_trend(spark, sf_dir):
    return roles.plain(s.product_monthly_trend(_shown(spark, sf_dir, p.ZONE_STATISTICS)))


QUERIES = {
    f.__name__: f
    for f in (
        product_zone_stats,
        product_weather,
        product_air,
        product_mobility,
        product_provenance,
        product_zone_demand,
        product_rain_distance,
        product_hourly_air,
        product_air_correlation,
        product_peak_hour,
        product_monthly_trend,
    )
}


def rounded_total(column: str) -> str:
    return f"ROUND({exact_total(column)}, 0)"


_MONTH = "CAST(date_trunc('month', tpep_pickup_datetime) AS TIMESTAMP)"
ZONE_SQL = f"""SELECT pu_zone, {_MONTH} AS month, COUNT(*) AS taxi_demand,
  {half_up(exact_mean('trip_distance'), 0)} AS avg_trip_distance, {rounded_total('trip_distance')} AS total_trip_distance,
  {half_up(exact_mean('fare_amount'), 0)} AS avg_fare_amount, {rounded_total('fare_amount')} AS total_fare_amount
FROM integrated GROUP BY 1, 2"""
WEATHER_SQL = f"""SELECT weather_prcp <> 0 AS is_raining, COUNT(*) AS taxi_demand,
  {half_up(exact_mean('trip_distance'), 2)} AS avg_trip_distance, {rounded_total('trip_distance')} AS total_trip_distance
FROM integrated WHERE trip_distance IS NOT NULL AND weather_prcp IS NOT NULL GROUP BY 1"""
AIR_SQL = f"""SELECT date_trunc('hour', tpep_pickup_datetime) AS pickup_hour, COUNT(*) AS taxi_demand,
  {mean('air_q_sample_measurement')} AS avg_air_quality,
  {half_up(exact_mean('trip_distance'), 0)} AS avg_trip_distance, {rounded_total('trip_distance')} AS total_trip_distance
FROM integrated WHERE air_q_sample_measurement IS NOT NULL GROUP BY 1"""
MOBILITY_SQL = f"""SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
  dayname(tpep_pickup_datetime) AS day_of_week, COUNT(*) AS taxi_demand,
  {half_up(exact_mean('trip_distance'), 0)} AS avg_trip_distance, {rounded_total('trip_distance')} AS total_trip_distance
FROM integrated GROUP BY 1, 2"""
_BASE = with_(INTEGRATED)

ORACLES = {
    "product_zone_stats": _BASE + ZONE_SQL,
    "product_weather": _BASE + WEATHER_SQL,
    "product_air": whole_means(_BASE) + AIR_SQL,
    "product_mobility": _BASE + MOBILITY_SQL,
    "product_provenance": f"""SELECT '{_SOURCE}' AS data_source, '2.0' AS schema_version, TRUE AS times_ok,
  COUNT(*) AS taxi_demand FROM events""",
    "product_zone_demand": _BASE + f"SELECT pu_zone, month, taxi_demand FROM ({ZONE_SQL})",
    "product_rain_distance": _BASE + f"SELECT is_raining, avg_trip_distance FROM ({WEATHER_SQL})",
    "product_hourly_air": whole_means(_BASE) + f"SELECT pickup_hour, taxi_demand, avg_air_quality FROM ({AIR_SQL})",
    "product_air_correlation": whole_means(_BASE)
    + f"SELECT round(corr(taxi_demand, avg_air_quality), 6) AS correlation FROM ({AIR_SQL})",
    "product_peak_hour": _BASE
    + f"""SELECT day_of_week, pickup_hour, taxi_demand FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY day_of_week ORDER BY taxi_demand DESC, pickup_hour) AS r FROM ({MOBILITY_SQL})) WHERE r = 1""",
    "product_monthly_trend": _BASE
    + f"""SELECT *, LAG(count) OVER (ORDER BY month) AS previous_count,
  count - LAG(count) OVER (ORDER BY month) AS difference FROM (
  SELECT {_MONTH} AS month, COUNT(*) AS count FROM integrated GROUP BY 1)""",
}
