import re

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions import convert, measures, timeparts
from farebox.functions.names import snake_case_all, to_snake_case
from farebox.operators import conform as c
from farebox.sources.city import city_specs, trips_spec, weather_spec
from farebox.sources.descriptor import DatasetSpec, DateTimePair, TimestampParts, load_specs, parse_type


@pytest.mark.parametrize(
    ("raw", "snake"),
    [
        ("PULocationID", "pu_location_id"),
        ("RatecodeID", "ratecode_id"),
        ("VendorID", "vendor_id"),
        ("Date of Last Change", "date_of_last_change"),
        (" Two  Words ", "two_words"),
        ("a--b", "a_b"),
        ("Airport_fee", "airport_fee"),
        ("MDL", "mdl"),
        ("tpep_pickup_datetime", "tpep_pickup_datetime"),
    ],
)
def test_snake_case(raw, snake):
    assert to_snake_case(raw) == snake


@given(st.text(alphabet="abXY 19_-", max_size=12))
def test_snake_case_is_stable(name):
    once = to_snake_case(name)
    assert to_snake_case(once) == once
    assert not re.search(r"[A-Z\s\-]|__", once)


def test_colliding_names_are_an_error():
    with pytest.raises(ValueError, match="a_b"):
        snake_case_all(["a b", "a-b"])


def test_unknown_type_is_an_error():
    with pytest.raises(ValueError, match="decimal"):
        parse_type("decimal")


def one(spark, schema, values, *exprs):
    return [tuple(r) for r in spark.createDataFrame(values, schema).coalesce(1).select(*exprs).collect()]


def test_booleans(spark):
    words = ["Y", " yes ", "TRUE", "1", "n", "No", "false", "0", "maybe", None]
    got = one(spark, "w string", [(w,) for w in words], convert.to_boolean(F.col("w")))
    assert [g[0] for g in got] == [True] * 4 + [False] * 4 + [None] * 2


def test_blank_to_null(spark):
    got = one(spark, "w string", [("",), ("   ",), (" x ",), (None,)], convert.blank_to_null(F.col("w")))
    assert [g[0] for g in got] == [None, None, "x", None]


def test_lenient_casts(spark):
    values = [("CC",), ("",), ("06",), ("99999999999",)]
    got = one(spark, "w string", values, *[convert.to_type(F.col("w"), t) for t in (T.IntegerType(), T.LongType())])
    assert got == [(None, None), (None, None), (6, 6), (None, 99999999999)]


def test_timestamp_from_parts(spark):
    values = [("2024", "1", "2", "3"), ("2024", "13", "1", "0"), ("2024", "1", None, "0"), ("2024", "1", "1", "24")]
    stamp = convert.timestamp_from_parts(*[F.col(n) for n in "ymdh"]).cast("string")
    got = one(spark, "y string, m string, d string, h string", values, stamp)
    assert [g[0] for g in got] == ["2024-01-02 03:00:00", None, None, None]


def test_timestamp_pair_and_codes(spark):
    pair = convert.timestamp_from_pair(F.col("d"), F.col("t"), "yyyy-MM-dd HH:mm").cast("string")
    values = [("2024-01-01", "05:30"), ("2024-01-01", "24:00"), (None, "05:30")]
    assert [g[0] for g in one(spark, "d string, t string", values, pair)] == ["2024-01-01 05:30:00", None, None]
    codes = one(spark, "c string", [("6",), ("36",), ("CC",), ("1234",), (None,)], convert.zero_pad(F.col("c"), 2))
    assert [g[0] for g in codes] == ["06", "36", "CC", "1234", None]


def test_clock_text_does_not_wrap(spark):
    got = one(spark, "s bigint", [(0,), (3661,), (90000,), (-5,), (None,)], timeparts.clock_text(F.col("s")))
    assert [g[0] for g in got] == ["00:00:00", "01:01:01", "25:00:00", "-00:00:05", None]


def test_weekday_name_is_the_formatted_name(spark):
    days = spark.range(14).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    wrong = days.filter(timeparts.weekday_name(F.weekday("d")) != F.date_format("d", "EEEE"))
    assert wrong.count() == 0


def test_correlation(spark):
    def corr(values):
        df = spark.createDataFrame(values, "a double, b double")
        return df.agg(measures.correlation(F.col("a"), F.col("b"))).first()[0]

    assert corr([(1.0, 2.0), (2.0, 4.0), (None, 9.0)]) == pytest.approx(1.0)
    assert corr([(1.0, 2.0), (1.0, 4.0)]) is None
    assert corr([(1.0, 2.0)]) is None
    assert corr([]) is None


def test_means_take_whole_values(spark):
    df = spark.createDataFrame([(1.2e-7,), (3.4e-7,), (1.4e-6,), (None,)], "x double")
    assert df.agg(measures.mean(F.col("x"))).first()[0] == pytest.approx(6.2e-7, rel=1e-12)
    assert df.agg(measures.total(F.col("x"))).first()[0] == pytest.approx(1.86e-6, rel=1e-12)
    assert df.limit(0).agg(measures.total(F.col("x"))).first()[0] is None


def test_shown_numbers_do_not_depend_on_order(spark):
    df = spark.range(1000).select((F.col("id") * 0.1).alias("x"))
    sums = {df.repartition(n).agg(measures.shown(measures.total(F.col("x")), 2)).first()[0] for n in (1, 3, 7)}
    assert len(sums) == 1


def test_numbers_that_are_not_finite_become_null(spark):
    texts = [("NaN",), ("Infinity",), ("-inf",), ("1e999",), ("2.5",), (None,), ("x",)]
    got = one(spark, "x string", texts, convert.to_type(F.col("x"), T.DoubleType()))
    assert [g[0] for g in got] == [None, None, None, None, 2.5, None, None]


def test_clipped_index(spark):
    got = one(spark, "x double", [(0.125,), (0.375,), (200.0,), (-1.0,), (None,)], measures.clipped_index(F.col("x"), 4.0, 0, 500))
    assert [g[0] for g in got] == [0, 2, 500, 0, None]


# -- descriptors and conformance -------------------------------------------------

CONF = {
    "format": "csv",
    "path": "x.csv",
    "primary_keys": ["Site ID"],
    "date_time_pairs": [
        {"date_col": "Date Local", "time_col": "Time Local", "output_col": "at", "format": "yyyy-MM-dd HH:mm"}
    ],
    "bool_cols": ["OK Flag"],
    "options": {"header": "true"},
    "schema": {"Site ID": "integer", "Date Local": "string", "Time Local": "string", "OK Flag": "string"},
}


def test_descriptor_from_json(tmp_path):
    path = tmp_path / "specs.json"
    import json

    path.write_text(json.dumps({"sites": CONF}))
    spec = load_specs(str(path))["sites"]
    assert spec.primary_keys == ("site_id",)
    assert spec.struct({"extra": T.DoubleType()}).simpleString() == (
        "struct<site_id:int,date_local:string,time_local:string,ok_flag:string,extra:double>"
    )
    assert spec.pairs == (DateTimePair("date_local", "time_local", "at", "yyyy-MM-dd HH:mm"),)
    assert spec.booleans == ("ok_flag",)


def test_city_specs():
    specs = {s.name: s for s in city_specs()}
    assert len(specs) == 6
    assert len(weather_spec().columns) == 24
    assert len(trips_spec().columns) == 19
    assert specs["air_quality"].primary_keys[0] == "state_code"
    assert weather_spec().parts == TimestampParts("year", "month", "day", "timestamp", hour="hour")


def test_schema_check_reports_everything(spark):
    spec = DatasetSpec.from_dict("t", {"format": "csv", "path": "", "schema": {"A": "int", "B": "long", "C": "string"}})
    df = spark.createDataFrame([], "a string, c string, d int")
    with pytest.raises(c.SchemaError) as caught:
        c.require_schema(df, spec)
    kinds = {(v.kind, v.column) for v in caught.value.violations}
    assert kinds == {("missing", "b"), ("extra", "d"), ("type", "a")}


def test_mixed_case_columns_are_cast(spark):
    """Declared raw names must reach the renamed columns."""
    df = c.standardize_columns(spark.createDataFrame([("7", "x")], "PULocationID string, VendorID string"))
    spec = DatasetSpec.from_dict("t", {"format": "csv", "path": "", "schema": {"PULocationID": "long", "VendorID": "long"}})
    assert [tuple(r) for r in c.cast_declared(df, spec).collect()] == [(7, None)]
    failures = {r["column_name"]: (r["present"], r["failed"]) for r in c.cast_failures(df, spec.columns).collect()}
    assert failures == {"pu_location_id": (1, 0), "vendor_id": (1, 1)}


def test_parse_keeps_timestamps(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS a, '02/01/2024' AS b")
    out = c.parse_timestamps(df, {"a": "dd/MM/yyyy", "b": "dd/MM/yyyy", "absent": "yyyy"})
    assert [str(v) for v in out.select(F.col("a").cast("string"), F.col("b").cast("string")).first()] == [
        "2024-01-01 00:00:00",
        "2024-01-02 00:00:00",
    ]


def test_schema_fingerprint_ignores_order(spark):
    a = spark.createDataFrame([], "x int, y string").schema
    b = spark.createDataFrame([], "y string, x int").schema
    assert c.schema_fingerprint(a) == c.schema_fingerprint(b)
    assert c.schema_fingerprint(a) != c.schema_fingerprint(spark.createDataFrame([], "x long, y string").schema)


def test_schema_diff():
    diff = c.schema_diff({"a": "int", "b": "int"}, {"b": "string", "c": "int"})
    assert [(d.column, d.change) for d in diff] == [("a", "removed"), ("b", "retyped"), ("c", "added")]
