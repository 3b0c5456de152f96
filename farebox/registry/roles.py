"""The test tables in the roles of the city datasets.

``events`` plays the trips; ``nation`` and ``region`` the zone lookup; hourly
summaries of the ``error`` events the weather; hourly summaries of the
``signup`` events per zone the air-quality measurements. ``lineitem`` with its orders, customers and suppliers
is the large fact. ``sql`` holds the same definitions for the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from farebox.functions.measures import STABLE_DIGITS, mean, shown
from farebox.functions.timeparts import hour_bucket
from farebox.operators.conform import convert_booleans, standardize_columns
from farebox.operators.joins import lookup_join
from farebox.plans.refresh import Catalog
from farebox.sources.scratch import path_exists, scratch_path

_stored: dict[tuple[str, str, str], tuple[str, StructType]] = {}
_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; its zone-less timestamps become session (UTC) timestamps.

    The schema of a file is looked up once; later reads need no job for it.
    """
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    df = spark.read.schema(_schemas[path]).parquet(path)
    naive = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


# Means that are returned as they are; their last digits depend on the order of adding up.
MEANS = ("air_q_sample_measurement", "air_quality", "avg_air_quality", "avg_fare", "sample_measurement")


def plain(df: DataFrame) -> DataFrame:
    """As the comparison side returns it: timestamps without zone, means without unstable digits."""
    changed = {c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"}
    changed |= {c: F.round(c, STABLE_DIGITS) for c in MEANS if c in df.columns}
    return df.withColumns(changed) if changed else df


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table kept for the session, as a real installation keeps its dimensions."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored or not path_exists(spark, f"{_stored[key][0]}/_SUCCESS"):
        frame = build(spark, sf_dir)
        path = scratch_path(spark, name)
        frame.write.parquet(path)
        _stored[key] = path, frame.schema
    path, schema = _stored[key]
    return spark.read.schema(schema).parquet(path)


def number() -> Column:
    """The number in the ``props`` of an event."""
    return F.get_json_object("props", "$.k").cast("int")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", number())


# -- trips ---------------------------------------------------------------------


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a raw trip file: mixed-case names, flags as words, gaps in the measures."""
    k = F.col("k")
    word = (
        F.when(F.col("event_type") == "click", "Y")
        .when(F.col("event_type") == "view", "n")
        .when(F.col("event_type") == "signup", " 1 ")
        .when(F.col("event_type") == "purchase", "No")
        .otherwise("maybe")
    )
    return events(spark, sf_dir).select(
        F.col("user_id").alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), k)).alias("tpep_dropoff_datetime"),
        (k % 7).cast("double").alias("passenger_count"),
        F.when(k != 99, F.col("value") / 10).alias("trip_distance"),
        (F.col("event_id") % 6).cast("double").alias("RatecodeID"),
        word.alias("store_and_fwd_flag"),
        (F.col("user_id") % 26).alias("PULocationID"),
        (k % 30).cast("bigint").alias("DOLocationID"),
        (F.col("event_id") % 5).alias("payment_type"),
        F.when(k != 98, F.col("value")).alias("fare_amount"),
        ((k % 3) * F.lit(0.5)).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (k * F.lit(0.25)).alias("tip_amount"),
        F.when(k % 2 == 0, F.lit(6.5)).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.lit(0.0).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.when(k % 5 == 0, F.lit(1.75)).alias("Airport_fee"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_booleans(standardize_columns(raw_trips(spark, sf_dir)), ["store_and_fwd_flag"])


# -- dimensions ------------------------------------------------------------------


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.lit("zone").alias("service_zone"),
    )


def _weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    k_total = F.sum("k")
    rain = F.when(k_total % 7 != 0, F.when(k_total % 3 == 0, F.lit(0.0)).otherwise(shown(mean(F.col("k")))))
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "error")
        .groupBy(hour_bucket(F.col("ts")).alias("timestamp"))
        .agg(
            shown(mean(F.col("value"))).alias("temp"),
            k_total.cast("double").alias("rhum"),
            rain.alias("prcp"),
        )
        .select(
            *[getattr(F, part)("timestamp").alias(part) for part in ("year", "month", "day", "hour")],
            "temp",
            "rhum",
            "prcp",
            "timestamp",
        )
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per hour with an error event."""
    return stored(spark, sf_dir, "weather", _weather)


def _air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    readings = (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "signup")
        .groupBy(
            F.when(k % 10 == 9, "34").otherwise("36").alias("state_code"),
            (F.col("user_id") % 26).alias("place"),
            hour_bucket(F.col("ts")).alias("datetime_local"),
        )
        .agg(shown(mean(F.when(k % 10 != 0, F.col("value"))), 2).alias("sample_measurement"))
    )
    placed = lookup_join(readings, zones(spark, sf_dir), "place", "location_id", {"borough": "county_name"})
    return placed.select(
        "state_code",
        "county_name",
        F.col("place").cast("string").alias("site_num"),
        "sample_measurement",
        "datetime_local",
    )


def air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station per zone: its hourly reading from the signup events, in the zone's region."""
    return stored(spark, sf_dir, "air-quality", _air_quality)


# -- history and update ------------------------------------------------------------

# The update repeats the last two days of history.
HISTORY_END = "2024-01-24"
UPDATE_START = "2024-01-22"
SHIPPED_HISTORY_END = "2001-01-01"
SHIPPED_UPDATE_START = "2000-09-01"


def split(df: DataFrame, time: str, history_end: str, update_start: str) -> tuple[DataFrame, DataFrame]:
    """Rows before one instant and rows from another on; together all rows."""
    return (
        df.filter(F.col(time) < F.lit(history_end).cast("timestamp")),
        df.filter(F.col(time) >= F.lit(update_start).cast("timestamp")),
    )


def split_trips(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split(trips(spark, sf_dir), "tpep_pickup_datetime", HISTORY_END, UPDATE_START)


def split_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    return split(lines, "l_shipdate", SHIPPED_HISTORY_END, SHIPPED_UPDATE_START)


def new_catalog(spark: SparkSession) -> Catalog:
    return Catalog(spark, scratch_path(spark, "catalog"))
