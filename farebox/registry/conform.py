"""Conformance operators on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions.convert import to_boolean
from farebox.operators import conform as c
from farebox.registry import roles
from farebox.registry.sql import EV, with_
from farebox.sources.descriptor import DatasetSpec, DateTimePair, TimestampParts
from farebox.sources.scratch import scratch_path
from farebox.sources.tables import Table


def conform_strings(spark, sf_dir):
    k = F.col("k")
    label = F.concat(F.lit("  "), F.upper("event_type"), F.lit(" "))
    raw = roles.events(spark, sf_dir).select(
        "event_id",
        F.when(k % 10 == 0, "   ").when(k % 10 == 1, "").otherwise(label).alias("label"),
        F.when(k % 3 != 0, F.concat(F.lit(" "), F.col("event_type"))).alias("note"),
    )
    return c.trim_strings(raw)


def conform_booleans(spark, sf_dir):
    raw = c.standardize_columns(roles.raw_trips(spark, sf_dir))
    flagged = raw.select("vendor_id", "tpep_pickup_datetime", "store_and_fwd_flag")
    return roles.plain(c.convert_booleans(flagged, ["store_and_fwd_flag"]))


def conform_timestamps(spark, sf_dir):
    text = F.when(F.col("k") % 50 == 0, "31/13/2024 10:00").otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm"))
    raw = roles.events(spark, sf_dir).select("event_id", F.col("ts").alias("kept"), text.alias("parsed"))
    fmt = "dd/MM/yyyy HH:mm"
    return roles.plain(c.parse_timestamps(raw, {"kept": fmt, "parsed": fmt}))


def assemble_timestamp(spark, sf_dir):
    raw = roles.events(spark, sf_dir).select(
        "event_id",
        F.year("ts").cast("string").alias("year"),
        F.month("ts").cast("string").alias("month"),
        F.col("k").cast("string").alias("day"),
        F.hour("ts").cast("string").alias("hour"),
    )
    parts = TimestampParts("year", "month", "day", "timestamp", hour="hour")
    return roles.plain(c.assemble_timestamp(raw, parts))


def date_time_pair(spark, sf_dir):
    time = F.when(F.col("k") % 25 == 0, "24:00").otherwise(F.date_format("ts", "HH:mm"))
    raw = roles.events(spark, sf_dir).select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("date_local"),
        F.when(F.col("k") % 7 != 0, time).alias("time_local"),
    )
    pair = DateTimePair("date_local", "time_local", "datetime_local", "yyyy-MM-dd HH:mm")
    return roles.plain(c.combine_date_time(raw, [pair]))


def snake_case_columns(spark, sf_dir):
    raw = roles.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("PULocationID"),
        F.col("l_partkey").alias("Date of Last Change"),
        F.col("l_suppkey").alias(" Two  Words "),
        F.col("l_linenumber").alias("a--b"),
        F.col("l_quantity").alias("Airport_fee"),
        F.col("l_tax").alias("RatecodeID"),
    )
    return c.standardize_columns(raw)


def prefix_columns(spark, sf_dir):
    return c.prefix_columns(roles.table(spark, sf_dir, "customer"), "buyer_")


_CAST_TYPES = {"as_int": T.IntegerType(), "as_long": T.LongType(), "as_double": T.DoubleType()}


def _cast_input(spark, sf_dir):
    k = F.col("k")
    text = (
        F.when(k % 10 == 0, "CC")
        .when(k % 10 == 1, "")
        .when(k % 10 == 2, "06")
        .when(k % 10 == 3, "99999999999")
        .otherwise(k.cast("string"))
    )
    return roles.events(spark, sf_dir).select("event_id", *[text.alias(n) for n in _CAST_TYPES])


_CAST_SQL = with_(
    EV,
    """raw AS (SELECT event_id, CASE k % 10 WHEN 0 THEN 'CC' WHEN 1 THEN '' WHEN 2 THEN '06'
  WHEN 3 THEN '99999999999' ELSE CAST(k AS VARCHAR) END AS t FROM ev)""",
)


def safe_cast(spark, sf_dir):
    return c.cast_columns(_cast_input(spark, sf_dir), _CAST_TYPES)


def schema_conformance_report(spark, sf_dir):
    """Every declared column: values present and values that do not fit the type."""
    return c.cast_failures(_cast_input(spark, sf_dir), _CAST_TYPES)


def align_to_target(spark, sf_dir):
    target = T.StructType(
        [
            T.StructField("flag", T.BooleanType()),
            T.StructField("seen_at", T.TimestampType()),
            T.StructField("seen_on", T.DateType()),
            T.StructField("amount", T.DoubleType()),
            T.StructField("user_id", T.LongType()),
        ]
    )
    raw = roles.events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("k") % 2 == 0, " Yes ").otherwise("0").alias("flag"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen_at"),
        F.date_format("ts", "yyyy-MM-dd").alias("seen_on"),
        F.col("value").cast("string").alias("amount"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("k").cast("string").alias("humidity"),
    )
    return roles.plain(c.align_to(raw, target, {"humidity": T.DoubleType()}))


def schema_check_report(spark, sf_dir):
    """A conformed frame against a descriptor: each violation with the rows it concerns."""
    spec = DatasetSpec.from_dict(
        "customers",
        {
            "format": "parquet",
            "path": "",
            "schema": {
                "c_custkey": "long",
                "c_name": "string",
                "c_nationkey": "long",
                "c_acctbal": "double",
                "c_phone": "string",
            },
        },
    )
    df = roles.table(spark, sf_dir, "customer")
    found = c.schema_violations(df.schema, spec)
    rows = df.agg(F.count("*").alias("n"), *[F.count(col).alias(col) for col in df.columns])
    entries = [
        F.struct(
            F.lit(v.kind).alias("kind"),
            F.lit(v.column).alias("column_name"),
            F.lit(v.expected).cast("string").alias("expected"),
            F.lit(v.actual).cast("string").alias("actual"),
            (F.col(v.column) if v.column in df.columns else F.col("n")).alias("rows_concerned"),
        )
        for v in found
    ]
    return rows.select(F.inline(F.array(*entries)))


def schema_drift_report(spark, sf_dir):
    old = roles.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    new = roles.events(spark, sf_dir).select(
        "event_id",
        "ts",
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("k") % 4 != 0, F.col("k")).alias("aqi"),
    )
    return c.drift_report(old, new)


def table_fingerprint(spark, sf_dir):
    """Version, columns, schema hash and row count of a stored table with two batches."""
    customers = roles.table(spark, sf_dir, "customer")
    stored = Table(spark, scratch_path(spark, "customers"))
    stored.append(customers.filter(F.col("c_acctbal") < 0).drop("c_mktsegment"))
    stored.append(customers.filter(F.col("c_acctbal") >= 0))
    seen = stored.fingerprint()
    return stored.read().agg(F.count("*").alias("row_count")).select(
        F.lit(seen.version).alias("version"),
        F.lit(",".join(seen.columns)).alias("columns"),
        F.lit(c.schema_fingerprint(stored.schema())).alias("schema_hash"),
        "row_count",
    )


def clean_flags(spark, sf_dir):
    """Boolean words of every kind, counted by their meaning."""
    words = ("Y", " yes ", "TRUE", "1", "n", "No", "false", "0", "maybe", "")
    word = F.element_at(F.array(*[F.lit(w) for w in words]), F.col("k") % 10 + 1)
    return roles.events(spark, sf_dir).groupBy(to_boolean(word).alias("meaning")).agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        conform_strings,
        conform_booleans,
        conform_timestamps,
        assemble_timestamp,
        date_time_pair,
        snake_case_columns,
        prefix_columns,
        safe_cast,
        schema_conformance_report,
        align_to_target,
        schema_check_report,
        schema_drift_report,
        table_fingerprint,
        clean_flags,
    )
}

ORACLES = {
    "conform_strings": with_(EV)
    + """SELECT event_id,
  CASE WHEN k % 10 > 1 THEN UPPER(event_type) END AS label,
  CASE WHEN k % 3 <> 0 THEN event_type END AS note FROM ev""",
    "conform_booleans": """SELECT user_id AS vendor_id, ts AS tpep_pickup_datetime,
  CASE event_type WHEN 'click' THEN TRUE WHEN 'signup' THEN TRUE
    WHEN 'view' THEN FALSE WHEN 'purchase' THEN FALSE END AS store_and_fwd_flag FROM events""",
    "conform_timestamps": with_(EV)
    + """SELECT event_id, ts AS kept, try_strptime(CASE WHEN k % 50 = 0 THEN '31/13/2024 10:00'
  ELSE strftime(ts, '%d/%m/%Y %H:%M') END, '%d/%m/%Y %H:%M') AS parsed FROM ev""",
    "assemble_timestamp": with_(EV)
    + """SELECT event_id, CAST(year(ts) AS VARCHAR) AS year, CAST(month(ts) AS VARCHAR) AS month,
  CAST(k AS VARCHAR) AS day, CAST(hour(ts) AS VARCHAR) AS hour,
  TRY_CAST(printf('%04d-%02d-%02d %02d:00:00', year(ts), month(ts), k, hour(ts)) AS TIMESTAMP) AS timestamp
FROM ev""",
    "date_time_pair": with_(
        EV,
        """raw AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_local,
  CASE WHEN k % 7 <> 0 THEN CASE WHEN k % 25 = 0 THEN '24:00' ELSE strftime(ts, '%H:%M') END END AS time_local
  FROM ev)""",
    )
    + "SELECT *, try_strptime(date_local || ' ' || time_local, '%Y-%m-%d %H:%M') AS datetime_local FROM raw",
    "snake_case_columns": """SELECT l_orderkey AS pu_location_id, l_partkey AS date_of_last_change,
  l_suppkey AS two_words, l_linenumber AS a_b, l_quantity AS airport_fee, l_tax AS ratecode_id FROM lineitem""",
    "prefix_columns": """SELECT c_custkey AS buyer_c_custkey, c_name AS buyer_c_name, c_nationkey AS buyer_c_nationkey,
  c_acctbal AS buyer_c_acctbal, c_mktsegment AS buyer_c_mktsegment FROM customer""",
    "safe_cast": _CAST_SQL
    + """SELECT event_id, TRY_CAST(t AS INTEGER) AS as_int, TRY_CAST(t AS BIGINT) AS as_long,
  TRY_CAST(t AS DOUBLE) AS as_double FROM raw""",
    "schema_conformance_report": _CAST_SQL
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, '{declared}' AS declared_type, COUNT(NULLIF(t, '')) AS present,
  COUNT(CASE WHEN t <> '' AND TRY_CAST(t AS {sql}) IS NULL THEN 1 END) AS failed FROM raw"""
        for name, declared, sql in (
            ("as_int", "int", "INTEGER"),
            ("as_long", "bigint", "BIGINT"),
            ("as_double", "double", "DOUBLE"),
        )
    ),
    "align_to_target": with_(EV)
    + """SELECT event_id, k % 2 = 0 AS flag, date_trunc('second', ts) AS seen_at, CAST(ts AS DATE) AS seen_on,
  value AS amount, user_id, CAST(k AS DOUBLE) AS humidity FROM ev""",
    "schema_check_report": """SELECT 'missing' AS kind, 'c_phone' AS column_name, 'string' AS expected,
  CAST(NULL AS VARCHAR) AS actual, COUNT(*) AS rows_concerned FROM customer
UNION ALL SELECT 'extra', 'c_mktsegment', NULL, 'string', COUNT(c_mktsegment) FROM customer
UNION ALL SELECT 'type', 'c_nationkey', 'bigint', 'int', COUNT(c_nationkey) FROM customer""",
    "schema_drift_report": with_(EV)
    + """SELECT 'aqi' AS column_name, 'added' AS change, CAST(NULL AS VARCHAR) AS old_type, 'int' AS new_type,
  COUNT(CASE WHEN k % 4 <> 0 THEN k END) AS filled FROM ev
UNION ALL SELECT 'props', 'removed', 'string', NULL, 0
UNION ALL SELECT 'user_id', 'retyped', 'bigint', 'string', COUNT(user_id) FROM ev""",
    "table_fingerprint": """SELECT CAST(1 AS INTEGER) AS version,
  'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS columns,
  sha256('c_acctbal:double,c_custkey:bigint,c_mktsegment:string,c_name:string,c_nationkey:int') AS schema_hash,
  COUNT(*) AS row_count FROM customer""",
    "clean_flags": with_(EV)
    + """SELECT CASE WHEN k % 10 < 4 THEN TRUE WHEN k % 10 < 8 THEN FALSE END AS meaning, COUNT(*) AS n
FROM ev GROUP BY 1""",
}
