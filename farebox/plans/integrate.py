"""Building the wide trip table.

One function serves the first build and every increment, so both give a trip
the same columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from farebox.functions.timeparts import day_bucket, hour_bucket
from farebox.operators.joins import area_hour_join, hour_join, lookup_join, reduce_per_area_hour
from farebox.sources.scratch import stage

AREA, AREA_TIME = "county_name", "datetime_local"
HOME_STATE = "36"


def with_hour(trips: DataFrame) -> DataFrame:
    """The hour a trip starts in, the key of the hourly dimensions."""
    return trips.withColumn("weather_time", hour_bucket(F.col("tpep_pickup_datetime")))


def with_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    return hour_join(trips, weather, "tpep_pickup_datetime", "timestamp", "weather_", "weather_time")


def with_zones(trips: DataFrame, zones: DataFrame, ends: Sequence[str] = ("pu", "do")) -> DataFrame:
    """Borough and zone of both trip ends, or of one."""
    for end in ends:
        names = {"borough": f"{end}_borough", "zone": f"{end}_zone"}
        trips = lookup_join(trips, zones, f"{end}_location_id", "location_id", names)
    return trips


def home_state(air: DataFrame, state_code: str = HOME_STATE) -> DataFrame:
    """Measurements of one state; codes are text and compared as text."""
    return air.filter(F.col("state_code") == state_code)


def air_per_area_hour(air: DataFrame, measures: Sequence[str] | None = None) -> DataFrame:
    """The side of the air-quality join with one row per area and hour."""
    return reduce_per_area_hour(home_state(air), AREA, AREA_TIME, measures)


def staged_air(air: DataFrame, measures: Sequence[str] | None = None) -> DataFrame:
    """``air_per_area_hour`` written to scratch.

    The planner cannot tell how far the reduction shrinks the measurements and
    would shuffle the trips; the written result shows it the real size.
    """
    return stage(air_per_area_hour(air, measures), "air")


def with_air(trips: DataFrame, air: DataFrame) -> DataFrame:
    """Attach air quality by pickup borough and hour; ``air`` decides how many rows per trip."""
    return area_hour_join(trips, air, "pu_borough", "weather_time", AREA, AREA_TIME, "air_q_")


def integrate(
    trips: DataFrame,
    weather: DataFrame,
    zones: DataFrame,
    air: DataFrame,
    per_trip: str = "one",
    measures: Sequence[str] | None = None,
) -> DataFrame:
    """Trips with weather, zones and air quality.

    ``per_trip="one"`` keeps the trip grain: each air-quality column (or each of ``measures``) is a
    summary over the stations of the area and hour. ``per_trip="many"`` repeats a trip for every
    station row, with all station columns; demand counted on it counts stations
    too. To get such counts without repeating any row, add up ``station_rows``
    over the trip-grain table.
    """
    if per_trip not in ("one", "many"):
        raise ValueError(f"per_trip must be 'one' or 'many', not {per_trip!r}")
    side = staged_air(air, measures) if per_trip == "one" else home_state(air)
    wide = with_air(with_zones(with_weather(trips, weather), zones), side)
    return wide.withColumn("day_timestamp", day_bucket(F.col("weather_time")))


def station_rows() -> Column:
    """How many rows a trip of the ``one`` form takes in the ``many`` form."""
    return F.greatest(F.coalesce(F.col("air_q_measurements"), F.lit(0)), F.lit(1))
