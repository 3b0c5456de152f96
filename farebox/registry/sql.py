"""SQL fragments: the roles of ``roles.py`` and a few expressions."""

from __future__ import annotations

from farebox.registry.roles import (
    HISTORY_END,
    SHIPPED_HISTORY_END,
    SHIPPED_UPDATE_START,
    UPDATE_START,
)

EV = "ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"

TRIPS = f"""{EV},
trips AS (
  SELECT user_id AS vendor_id, ts AS tpep_pickup_datetime, ts + to_minutes(k) AS tpep_dropoff_datetime,
    CAST(k % 7 AS DOUBLE) AS passenger_count,
    CASE WHEN k <> 99 THEN value / 10 END AS trip_distance,
    CAST(event_id % 6 AS DOUBLE) AS ratecode_id,
    CASE event_type WHEN 'click' THEN TRUE WHEN 'signup' THEN TRUE
      WHEN 'view' THEN FALSE WHEN 'purchase' THEN FALSE END AS store_and_fwd_flag,
    user_id % 26 AS pu_location_id, CAST(k % 30 AS BIGINT) AS do_location_id,
    event_id % 5 AS payment_type,
    CASE WHEN k <> 98 THEN value END AS fare_amount,
    (k % 3) * 0.5::DOUBLE AS extra, 0.5::DOUBLE AS mta_tax, k * 0.25::DOUBLE AS tip_amount,
    CASE WHEN k % 2 = 0 THEN 6.5::DOUBLE END AS tolls_amount,
    1.0::DOUBLE AS improvement_surcharge, 0.0::DOUBLE AS total_amount,
    2.5::DOUBLE AS congestion_surcharge, CASE WHEN k % 5 = 0 THEN 1.75::DOUBLE END AS airport_fee
  FROM ev)"""

ZONES = """zones AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone, 'zone' AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def exact_total(expr: str) -> str:
    """Sum of whole values that does not depend on the order of adding up: decimals, and what they leave."""
    value = f"CAST({expr} AS DOUBLE)"
    first = f"CAST({value} AS DECIMAL(38,10))"
    return f"(CAST(SUM({first}) AS DOUBLE) + SUM({value} - CAST({first} AS DOUBLE)))"


def exact_mean(expr: str) -> str:
    return f"({exact_total(expr)} / COUNT({expr}))"


def total(expr: str) -> str:
    return half_up(exact_total(expr), 6)


def mean(expr: str) -> str:
    return half_up(exact_mean(expr), 6)


def whole_means(sql: str) -> str:
    """The SQL with station means that are not rounded, for queries that average them once more."""
    return sql.replace(mean("sample_measurement") + " AS sample_measurement", exact_mean("sample_measurement") + " AS sample_measurement")


def half_up(expr: str, digits: int) -> str:
    """Decimal rounding of the shortest text of a double, ties away from zero."""
    return f"CAST(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,{digits})) AS DOUBLE)"


WEATHER = f"""weather AS (
  SELECT CAST(year(h) AS INTEGER) AS year, CAST(month(h) AS INTEGER) AS month,
    CAST(day(h) AS INTEGER) AS day, CAST(hour(h) AS INTEGER) AS hour, temp, rhum, prcp, h AS timestamp
  FROM (SELECT date_trunc('hour', ts) AS h, {mean('value')} AS temp, CAST(SUM(k) AS DOUBLE) AS rhum,
      CASE WHEN SUM(k) % 7 = 0 THEN NULL WHEN SUM(k) % 3 = 0 THEN 0.0::DOUBLE ELSE {mean('k')} END AS prcp
    FROM ev WHERE event_type = 'error' GROUP BY 1))"""

AIR = f"""air AS (
  SELECT state_code, borough AS county_name, CAST(place AS VARCHAR) AS site_num, sample_measurement, datetime_local
  FROM (SELECT CASE WHEN k % 10 = 9 THEN '34' ELSE '36' END AS state_code, user_id % 26 AS place,
      date_trunc('hour', ts) AS datetime_local,
      {half_up(exact_mean('CASE WHEN k % 10 <> 0 THEN value END'), 2)} AS sample_measurement
    FROM ev WHERE event_type = 'signup' GROUP BY 1, 2, 3)
  LEFT JOIN zones ON place = location_id)"""

AIR_ONE = f"""air_one AS (
  SELECT county_name, datetime_local, {mean('sample_measurement')} AS sample_measurement,
    COUNT(*) AS measurements
  FROM air WHERE state_code = '36' AND county_name IS NOT NULL GROUP BY 1, 2)"""

_WIDE = """SELECT t.*, w.timestamp IS NOT NULL AS weather_matched, w.temp AS weather_temp, w.rhum AS weather_rhum,
    w.prcp AS weather_prcp, pz.borough AS pu_borough, pz.zone AS pu_zone, dz.borough AS do_borough,
    dz.zone AS do_zone, a.datetime_local IS NOT NULL AS air_q_matched,
    a.sample_measurement AS air_q_sample_measurement, {air_columns},
    date_trunc('hour', t.tpep_pickup_datetime) AS weather_time,
    CAST(date_trunc('day', t.tpep_pickup_datetime) AS TIMESTAMP) AS day_timestamp
  FROM {trips} t
  LEFT JOIN {weather} w ON date_trunc('hour', t.tpep_pickup_datetime) = w.timestamp
  LEFT JOIN zones pz ON t.pu_location_id = pz.location_id
  LEFT JOIN zones dz ON t.do_location_id = dz.location_id
  LEFT JOIN {air} a ON pz.borough = a.county_name
    AND date_trunc('hour', t.tpep_pickup_datetime) = a.datetime_local"""


def wide(trips: str = "trips", weather: str = "weather", air: str = "air_one") -> str:
    columns = "a.measurements AS air_q_measurements" if air.startswith("air_one") else "a.site_num AS air_q_site_num"
    source = air if air.startswith("air_one") else f"(SELECT * FROM {air} WHERE state_code = '36')"
    return _WIDE.format(trips=trips, weather=weather, air=source, air_columns=columns)


ROLES = f"{TRIPS},\n{ZONES},\n{WEATHER},\n{AIR},\n{AIR_ONE}"
INTEGRATED = f"{ROLES},\nintegrated AS ({wide()})"

HISTORY = f"tpep_pickup_datetime < TIMESTAMP '{HISTORY_END}'"
UPDATE = f"tpep_pickup_datetime >= TIMESTAMP '{UPDATE_START}'"
OLD_LINES = f"(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{SHIPPED_HISTORY_END}')"
NEW_LINES = f"(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SHIPPED_UPDATE_START}')"

LINE_KEY = "l_orderkey, l_linenumber"
LINE_REST = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)


def one_per_key(source: str) -> str:
    """One row per line key, the first in the order of the other columns."""
    return f"""SELECT {LINE_KEY}, {LINE_REST} FROM (SELECT *, ROW_NUMBER() OVER (
      PARTITION BY {LINE_KEY} ORDER BY {LINE_REST}) AS r FROM {source}) WHERE r = 1"""


def with_(*fragments: str) -> str:
    return "WITH " + ",\n".join(fragments) + "\n"
