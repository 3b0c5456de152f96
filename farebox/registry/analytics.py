"""Analytical queries on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from farebox.functions.measures import mean as mean_of, shown
from farebox.functions.timeparts import month_bucket
from farebox.measure import cached as held
from farebox.operators import summaries as s
from farebox.operators.joins import lookup_join
from farebox.operators.mergeable import Measure, merge_state, partial_state, present_state
from farebox.operators.ordering import stored_order
from farebox.operators.rowsets import difference_counts
from farebox.plans import integrate as wide
from farebox.registry import roles
from farebox.registry.sql import INTEGRATED, TRIPS, ZONES, exact_mean, half_up, mean, total, whole_means, with_
from farebox.session import scoped_conf
from farebox.sources.scratch import scratch_path, stage
from farebox.sources.tables import Table

# Each query joins only the dimensions it needs; the integrated table stores all of them.


def _zoned(spark, sf_dir):
    return wide.with_zones(roles.trips(spark, sf_dir), roles.zones(spark, sf_dir))


def pickup_zoned(spark, sf_dir):
    return wide.with_zones(roles.trips(spark, sf_dir), roles.zones(spark, sf_dir), ["pu"])


def weathered(spark, sf_dir):
    return wide.with_weather(roles.trips(spark, sf_dir), roles.weather(spark, sf_dir))


def aired(spark, sf_dir):
    air = wide.staged_air(roles.air_quality(spark, sf_dir))
    return wide.with_air(wide.with_hour(pickup_zoned(spark, sf_dir)), air)


def trips_per_borough(spark, sf_dir):
    return s.trips_per_area(pickup_zoned(spark, sf_dir))


def avg_duration_per_day(spark, sf_dir):
    return roles.plain(s.average_duration_per_day(roles.trips(spark, sf_dir)))


def avg_fare_per_borough(spark, sf_dir):
    return roles.plain(s.average_fare_per_area(pickup_zoned(spark, sf_dir)))


def fare_one_borough(spark, sf_dir):
    return s.average_fare_in_area(pickup_zoned(spark, sf_dir), "ASIA")


def zone_monthly_demand(spark, sf_dir):
    return roles.plain(s.zone_monthly_demand(pickup_zoned(spark, sf_dir)))


def distance_by_rain(spark, sf_dir):
    return s.distance_by_rain(weathered(spark, sf_dir))


def hourly_demand_air(spark, sf_dir):
    return roles.plain(s.hourly_demand_and_air(aired(spark, sf_dir)))


def demand_air_correlation(spark, sf_dir):
    hourly = s.hourly_demand_and_air(aired(spark, sf_dir))
    return s.correlation_of(hourly, "air_quality", "taxi_demand").select(F.round("correlation", 6).alias("correlation"))


def rain_demand_variation(spark, sf_dir):
    return s.rain_demand_variation(wide.with_weather(pickup_zoned(spark, sf_dir), roles.weather(spark, sf_dir)))


def peak_hour_by_weekday(spark, sf_dir):
    return s.peak_hour_by_weekday(roles.trips(spark, sf_dir))


def monthly_trend(spark, sf_dir):
    """On the order dates of the large fact, which span 80 months."""
    orders = roles.table(spark, sf_dir, "orders")
    return roles.plain(s.monthly_trend(orders, "o_orderdate"))


# -- the large fact -----------------------------------------------------------------

_LINE_MEASURES = (Measure("l_quantity", "quantity", 4, 4), Measure("l_extendedprice", "price", 4, 4))


def shipment_zone_statistics(spark, sf_dir):
    """Demand, quantity and price of order lines per customer zone and order month.

    The lines are summed up per order first: the shuffle this takes is the one
    the join with the orders needs anyway, an order with very many lines is
    reduced before it, and the joins move sums instead of lines.
    """
    lines = roles.table(spark, sf_dir, "lineitem")
    orders = roles.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", month_bucket(F.col("o_orderdate")).alias("month")
    )
    customers = roles.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    placed = (
        partial_state(lines, ["l_orderkey"], _LINE_MEASURES)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
    )
    per_zone = merge_state([placed], ["c_nationkey", "month"], _LINE_MEASURES)
    named = lookup_join(per_zone, roles.zones(spark, sf_dir), "c_nationkey", "location_id", {"zone": "pu_zone"})
    return roles.plain(present_state(named, ["pu_zone", "month"], _LINE_MEASURES))


def shipment_weekday_peak(spark, sf_dir):
    """Busiest supplier zone for each weekday of shipping."""
    lines = roles.table(spark, sf_dir, "lineitem")
    suppliers = roles.table(spark, sf_dir, "supplier")
    counts = s.count_by(lines, {"l_suppkey": F.col("l_suppkey"), "weekday": F.weekday("l_shipdate")})
    placed = counts.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    zoned = lookup_join(placed, roles.zones(spark, sf_dir), "s_nationkey", "location_id", {"zone": "do_zone"})
    totals = s.total_by(zoned, ["weekday", "do_zone"], "count", "shipments")
    top = s.top_per_group(totals, ["weekday"], [F.desc("shipments"), F.asc("do_zone")])
    return top.select(s.weekday_name(F.col("weekday")).alias("day_of_week"), "do_zone", "shipments")


def shipment_monthly_trend(spark, sf_dir):
    """Lines per month of order and the change from the month before, from a summary of many months."""
    return roles.plain(s.product_monthly_trend(shipment_zone_statistics(spark, sf_dir)))


def mean_below_edge(spark, sf_dir):
    """Means that lie just below the edge between two numbers of two digits, shown with two digits."""
    lines = roles.table(spark, sf_dir, "lineitem")
    below = F.col("l_quantity") / 8 - F.lit(0.0000000004)
    return lines.groupBy("l_quantity").agg(shown(mean_of(below), 2).alias("mean_shown"))


def orders_by_price(spark, sf_dir):
    """Orders stored by falling price: rows, files and the steps that go the wrong way, found by reading the files again."""
    path = scratch_path(spark, "sorted-orders")
    order = [("o_totalprice", False), ("o_orderkey", True)]
    orders = roles.table(spark, sf_dir, "orders")
    orders.orderBy(F.desc("o_totalprice"), F.asc("o_orderkey")).write.parquet(path)
    return stored_order(spark.read.schema(orders.schema).parquet(path), order).drop("files")


def mobility_in_order(spark, sf_dir):
    """The stored mobility summary in order of weekday and hour, checked the same way."""
    path = scratch_path(spark, "sorted-mobility")
    trips = roles.trips(spark, sf_dir).groupBy(
        F.weekday("tpep_pickup_datetime").alias("day_of_week"), F.hour("tpep_pickup_datetime").alias("pickup_hour")
    )
    demand = trips.agg(F.count("*").alias("taxi_demand"))
    demand.orderBy("day_of_week", "pickup_hour").write.parquet(path)
    return stored_order(spark.read.schema(demand.schema).parquet(path), [("day_of_week", True), ("pickup_hour", True)]).drop("files")


# -- physical variants that must agree ---------------------------------------------------


def adaptive_agrees(spark, sf_dir):
    """Busiest hours planned adaptively, after they were compared with those of the fixed plan."""
    peaks = s.peak_hour_by_weekday(roles.trips(spark, sf_dir))
    with scoped_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        fixed = stage(peaks, "fixed-plan")
    counts = difference_counts(fixed, peaks)
    return s.peak_hour_by_weekday(roles.trips(spark, sf_dir)).select(
        counts.select("only_left").scalar().alias("only_left"),
        counts.select("only_right").scalar().alias("only_right"),
        "*",
    )


def cached_agrees(spark, sf_dir):
    """Zone demand from a held projection and from the source, compared; one row per zone and month."""
    base = pickup_zoned(spark, sf_dir).select("pu_zone", "tpep_pickup_datetime")
    with held(base) as memory:
        kept = Table(spark, scratch_path(spark, "cached-demand"))
        kept.append(s.zone_monthly_demand(memory))
    direct = s.zone_monthly_demand(base).withColumnRenamed("count", "direct_count")
    both = kept.read().alias("c").join(
        direct.alias("d"),
        F.col("c.pu_zone").eqNullSafe(F.col("d.pu_zone")) & F.col("c.month").eqNullSafe(F.col("d.month")),
        "left",
    )
    return roles.plain(both.select("c.pu_zone", "c.month", "c.count", "d.direct_count"))


QUERIES = {
    f.__name__: f
    for f in (
        trips_per_borough,
        avg_duration_per_day,
        avg_fare_per_borough,
        fare_one_borough,
        zone_monthly_demand,
        distance_by_rain,
        hourly_demand_air,
        demand_air_correlation,
        rain_demand_variation,
        peak_hour_by_weekday,
        monthly_trend,
        shipment_zone_statistics,
        shipment_weekday_peak,
        shipment_monthly_trend,
        mean_below_edge,
        adaptive_agrees,
        orders_by_price,
        mobility_in_order,
        cached_agrees,
    )
}

_PICKUP = with_(TRIPS, ZONES, """zoned AS (SELECT t.*, borough AS pu_borough, zone AS pu_zone
  FROM trips t LEFT JOIN zones ON pu_location_id = location_id)""")
_MONTH = "CAST(date_trunc('month', {}) AS TIMESTAMP) AS month"
_HOURLY = """hourly AS (SELECT date_trunc('hour', tpep_pickup_datetime) AS hour, COUNT(*) AS taxi_demand,
  {} AS air_quality FROM integrated WHERE air_q_sample_measurement IS NOT NULL GROUP BY 1)""".format(
    mean("air_q_sample_measurement")
)
_ONE_FARE = f"SELECT pu_borough, {half_up(exact_mean('fare_amount'), 4)} AS avg_fare FROM zoned WHERE pu_borough = 'ASIA' GROUP BY 1"
_ZONE_DEMAND = f"SELECT pu_zone, {_MONTH.format('tpep_pickup_datetime')}, COUNT(*) AS count FROM zoned GROUP BY 1, 2"

_PEAKS = """SELECT day_of_week, hour, count FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY day_of_week ORDER BY count DESC, hour) AS r FROM (
    SELECT dayname(ts) AS day_of_week, CAST(hour(ts) AS INTEGER) AS hour, COUNT(*) AS count FROM events GROUP BY 1, 2))
WHERE r = 1"""

ORACLES = {
    "trips_per_borough": _PICKUP + "SELECT pu_borough, COUNT(*) AS count FROM zoned GROUP BY 1",
    "avg_duration_per_day": with_(TRIPS)
    + """SELECT day_timestamp, trip_seconds, printf('%02d:%02d:%02d', trip_seconds // 3600,
  trip_seconds // 60 % 60, trip_seconds % 60) AS trip_time FROM (
  SELECT CAST(date_trunc('day', tpep_pickup_datetime) AS TIMESTAMP) AS day_timestamp, CAST(floor(AVG(
    epoch(date_trunc('second', tpep_dropoff_datetime)) - epoch(date_trunc('second', tpep_pickup_datetime)))) AS BIGINT)
    AS trip_seconds FROM trips GROUP BY 1)""",
    "avg_fare_per_borough": _PICKUP + f"SELECT pu_borough, {mean('fare_amount')} AS avg_fare FROM zoned GROUP BY 1",
    "fare_one_borough": _PICKUP + _ONE_FARE,
    "zone_monthly_demand": _PICKUP + _ZONE_DEMAND,
    "distance_by_rain": with_(INTEGRATED)
    + f"""SELECT weather_prcp <> 0 AS is_raining, {half_up(exact_mean('trip_distance'), 2)} AS avg_trip_distance
FROM integrated WHERE weather_prcp IS NOT NULL AND trip_distance IS NOT NULL GROUP BY 1""",
    "hourly_demand_air": whole_means(with_(INTEGRATED, _HOURLY)) + "SELECT * FROM hourly",
    "demand_air_correlation": whole_means(with_(INTEGRATED, _HOURLY))
    + "SELECT round(corr(air_quality, taxi_demand), 6) AS correlation FROM hourly",
    "rain_demand_variation": with_(INTEGRATED)
    + """SELECT pu_zone, COUNT(CASE WHEN weather_prcp = 0 THEN 1 END) AS no_rain_demand,
  COUNT(CASE WHEN weather_prcp <> 0 THEN 1 END) AS rain_demand,
  abs(COUNT(CASE WHEN weather_prcp <> 0 THEN 1 END) - COUNT(CASE WHEN weather_prcp = 0 THEN 1 END)) AS demand_variation
FROM integrated WHERE pu_zone IS NOT NULL AND weather_prcp IS NOT NULL GROUP BY 1""",
    "peak_hour_by_weekday": _PEAKS,
    "adaptive_agrees": f"SELECT CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right, * FROM ({_PEAKS})",
    "monthly_trend": f"""SELECT *, LAG(count) OVER (ORDER BY month) AS previous_count,
  count - LAG(count) OVER (ORDER BY month) AS difference
FROM (SELECT {_MONTH.format('o_orderdate')}, COUNT(*) AS count FROM orders GROUP BY 1)""",
    "shipment_zone_statistics": f"""SELECT n_name AS pu_zone, {_MONTH.format('o_orderdate')}, COUNT(*) AS taxi_demand,
  {half_up(exact_mean('l_quantity'), 4)} AS avg_quantity, {total('l_quantity')} AS total_quantity,
  {half_up(exact_mean('l_extendedprice'), 4)} AS avg_price, {total('l_extendedprice')} AS total_price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
    "shipment_weekday_peak": """SELECT day_of_week, do_zone, shipments FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY day_of_week ORDER BY shipments DESC, do_zone) AS r FROM (
    SELECT dayname(l_shipdate) AS day_of_week, n_name AS do_zone, COUNT(*) AS shipments
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2))
WHERE r = 1""",
    "shipment_monthly_trend": f"""SELECT *, LAG(count) OVER (ORDER BY month) AS previous_count,
  count - LAG(count) OVER (ORDER BY month) AS difference
FROM (SELECT {_MONTH.format('o_orderdate')}, COUNT(*) AS count FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)""",
    "mean_below_edge": f"""SELECT l_quantity, {half_up(exact_mean('l_quantity / 8 - 0.0000000004'), 2)} AS mean_shown
FROM lineitem GROUP BY 1""",
    "orders_by_price": "SELECT COUNT(*) AS row_count, CAST(0 AS BIGINT) AS out_of_order FROM orders",
    "mobility_in_order": """SELECT COUNT(DISTINCT (dayofweek(ts), hour(ts))) AS row_count, CAST(0 AS BIGINT) AS out_of_order
FROM events""",
    "cached_agrees": _PICKUP + f"SELECT *, count AS direct_count FROM ({_ZONE_DEMAND})",
}
