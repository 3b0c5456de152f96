"""Quality, row sets, joins and ranking on small frames, brute force as the judge."""

import random
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from farebox.functions import measures
from farebox.measure import plan_text
from farebox.operators import joins, quality, ranking, rowsets, summaries
from farebox.operators.merge import fill_unmatched, key_condition, rows_with_new_key
from farebox.operators.ordering import stored_order

SCHEMA = "a int, b string"
ROWS = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from("xy"))), max_size=12
)
FEW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def as_counter(df):
    return Counter(tuple(r) for r in df.collect())


@FEW
@given(left=ROWS, right=ROWS)
def test_set_operators_against_python(spark, left, right):
    l, r = (spark.createDataFrame(x, SCHEMA) for x in (left, right))
    assert as_counter(rowsets.multiset_difference(l, r)) == Counter(left) - Counter(right)
    assert as_counter(rowsets.multiset_difference(l, r)) == as_counter(l.exceptAll(r))
    assert set(as_counter(rowsets.novel_rows(l, r))) == set(left) - set(right)
    counts = rowsets.difference_counts(l, r).first()
    assert counts["only_left"] == sum((Counter(left) - Counter(right)).values())
    assert counts["only_right"] == sum((Counter(right) - Counter(left)).values())
    assert rowsets.frames_equal(l, r) == (Counter(left) == Counter(right))
    overlap = joins.key_overlap(l, r, ["a"]).first()
    pairs = sum(1 for x in left for y in right if x[0] is not None and x[0] == y[0])
    assert overlap["matched_pairs"] == pairs
    assert overlap["update_rows"] == len(left)
    assert overlap["matched_rows"] == sum(1 for x in left if x[0] is not None and x[0] in {y[0] for y in right})


@FEW
@given(source=ROWS, existing=ROWS)
def test_insert_when_key_is_new(spark, source, existing):
    s, e = (spark.createDataFrame(x, SCHEMA) for x in (source, existing))
    got = as_counter(rows_with_new_key(quality.quality_gate(s, ["a"]), e, ["a"]))
    stored = {x[0] for x in existing}
    wanted = {}
    for a, b in source:
        if a is not None and a not in stored:
            wanted[a] = min((b, wanted.get(a, b)), key=lambda v: (v is None, v))
    assert got == Counter(wanted.items())


@FEW
@given(values=ROWS)
def test_quality_counts_agree_with_the_gate(spark, values):
    df = spark.createDataFrame(values, SCHEMA)
    counts = quality.quality_counts(df, ["a"]).first()
    assert counts["processed"] == len(values)
    assert counts["null_key"] == sum(a is None for a, _ in values)
    assert counts["kept"] == quality.quality_gate(df, ["a"]).count()
    assert counts["processed"] == counts["null_key"] + counts["duplicate"] + counts["kept"]
    whole = quality.quality_counts(df, []).first()
    assert whole["kept"] == len(set(values)) == quality.quality_gate(df, []).count()


def test_zero_and_minus_zero_are_the_same_row(spark):
    update = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    history = spark.createDataFrame([(-0.0,)], "x double")
    assert [r[0] for r in rowsets.novel_rows(update, history).collect()] == [1.0]


def test_novel_rows_with_time_range(spark):
    schema = "t timestamp, x int"
    update = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2024-01-02', 1), (NULL, 2), (TIMESTAMP '2024-01-03', 3) AS v(t, x)")
    history = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2024-01-02', 1), (NULL, 2), (TIMESTAMP '2020-01-01', 9) AS v(t, x)")
    assert [r["x"] for r in rowsets.novel_rows(update, history, "t").collect()] == [3]
    untimed = spark.createDataFrame([(None, 2), (None, 5)], schema)
    assert [r["x"] for r in rowsets.novel_rows(untimed, history, "t").collect()] == [5]
    assert rowsets.novel_rows(spark.createDataFrame([], schema), history, "t").count() == 0


def test_snapshot_diff_keeps_rows_with_nulls_and_added_columns(spark):
    earlier = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "a int, b string")
    current = spark.createDataFrame(
        [(1, None, 5), (2, "x", 6), (2, "x", 7), (3, None, None), (3, None, None)], "a int, b string, c int"
    )
    assert as_counter(rowsets.snapshot_diff(current, earlier)) == Counter([(3, None, None)])
    assert as_counter(rowsets.snapshot_diff(current.select("a", "b"), earlier)) == Counter([(3, None)])
    grown = current.union(spark.createDataFrame([(2, "x", 8)], current.schema))
    assert set(as_counter(rowsets.snapshot_diff(grown, earlier))) == {(3, None, None), (2, "x", 6), (2, "x", 7), (2, "x", 8)}


def test_repeat_rows_crosses_chunks(spark):
    df = spark.createDataFrame([("hot", 200_000), ("one", 1), ("none", 0)], "k string, n bigint")
    assert dict(rowsets.repeat_rows(df, "n").groupBy("k").count().collect()) == {"hot": 200_000, "one": 1}


def test_survivor_is_deterministic(spark):
    values = [(1, "b", None), (1, "a", 2), (1, "a", 1), (2, None, 1), (2, "z", 9)]
    for n in (1, 3):
        df = spark.createDataFrame(values, "k int, x string, y int").repartition(n)
        kept = {r["k"]: (r["x"], r["y"]) for r in quality.one_row_per_key(df, ["k"]).collect()}
        assert kept == {1: ("a", 1), 2: ("z", 9)}
        latest = quality.one_row_per_key(df, ["k"], [F.desc_nulls_last("y")]).collect()
        assert {r["k"]: r["y"] for r in latest} == {1: 2, 2: 9}


def test_hour_join_edges(spark):
    trips = spark.sql(
        "SELECT id, CAST(t AS TIMESTAMP) AS t FROM VALUES (1, '2024-01-01 10:00:00'), (2, '2024-01-01 10:59:59'),"
        " (3, '2024-01-01 11:00:00'), (4, NULL) AS v(id, t)"
    )
    dim = spark.sql("SELECT TIMESTAMP '2024-01-01 10:00:00' AS ts, CAST(NULL AS DOUBLE) AS temp")
    out = joins.hour_join(trips, dim, "t", "ts", "w_", "hour")
    assert {r["id"]: r["w_matched"] for r in out.collect()} == {1: True, 2: True, 3: False, 4: False}
    assert out.columns == ["id", "t", "hour", "w_temp", "w_matched"]


def test_area_join_one_and_many(spark):
    trips = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, None)], "id int, area string").withColumn(
        "h", F.lit("2024-01-01").cast("timestamp")
    )
    air = spark.createDataFrame([("A", 1.0), ("A", None), ("A", 5.0), ("B", None), (None, 7.0)], "area string, m double")
    air = air.withColumn("h", F.lit("2024-01-01").cast("timestamp"))
    many = joins.area_hour_join(trips, air, "area", "h", "area", "h", "q_")
    assert Counter(r["id"] for r in many.collect()) == {1: 3, 2: 1, 3: 1, 4: 1}
    one = joins.area_hour_join(trips, joins.reduce_per_area_hour(air, "area", "h", ["m"]), "area", "h", "area", "h", "q_")
    got = {r["id"]: (r["q_matched"], r["q_m"], r["q_measurements"]) for r in one.collect()}
    assert got == {1: (True, 3.0, 3), 2: (True, None, 1), 3: (False, None, None), 4: (False, None, None)}


def test_rain_variation(spark):
    values = [("dry", 0.0)] * 2 + [("wet", 1.5)] + [("both", 0.0)] * 3 + [("both", 2.0), ("dry", None), (None, 1.0)]
    df = spark.createDataFrame(values, "pu_zone string, weather_prcp double")
    got = [tuple(r) for r in summaries.rain_demand_variation(df).collect()]
    assert got == [("both", 3, 1, 2), ("dry", 2, 0, 2), ("wet", 0, 1, 1)]
    ascending = [r[0] for r in summaries.rain_demand_variation(df, largest_first=False).collect()]
    assert ascending == ["wet", "both", "dry"]


def test_top_per_group_breaks_ties(spark):
    df = spark.createDataFrame([("Mon", 8, 5), ("Mon", 7, 5), ("Tue", 1, 2)], "d string, h int, n int")
    got = {tuple(r) for r in ranking.top_per_group(df, ["d"], [F.desc("n"), F.asc("h")]).collect()}
    assert got == {("Mon", 7, 5), ("Tue", 1, 2)}


def test_change_from_previous(spark):
    one = spark.createDataFrame([(1, 10)], "m int, count bigint")
    assert [tuple(r) for r in ranking.change_from_previous(one, "m", "count").collect()] == [(1, 10, None, None)]
    gap = spark.createDataFrame([(5, 4), (1, 10)], "m int, count bigint")
    assert [tuple(r) for r in ranking.change_from_previous(gap, "m", "count").collect()] == [
        (1, 10, None, None),
        (5, 4, 10, -6),
    ]


def test_fill_unmatched_leaves_matched_rows_alone(spark):
    target = spark.createDataFrame(
        [(1, True, None), (2, False, None), (3, False, None)], "h int, w_matched boolean, w_temp double"
    )
    source = spark.createDataFrame([(1, 9.0, 1), (2, 8.0, 2)], "w_h int, w_temp double, w_new int")
    out = fill_unmatched(target, source, [("h", "w_h")], ["w_temp", "w_new"], "w_matched")
    assert {tuple(r) for r in out.collect()} == {(1, True, None, None), (2, True, 8.0, 2), (3, False, None, None)}
    again = fill_unmatched(out, source, [("h", "w_h")], ["w_temp", "w_new"], "w_matched")
    assert rowsets.frames_equal(out, again)


def test_key_condition_null_switch(spark):
    left = spark.createDataFrame([(None, 1)], "k int, x int")
    right = spark.createDataFrame([(None, 2)], "k int, y int")
    assert left.join(right, key_condition(left, right, ["k"])).count() == 0
    assert left.join(right, key_condition(left, right, ["k"], null_safe=True)).count() == 1


# -- plans ---------------------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key and are exact copies."""
    hot = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("x"),
    )
    return hot


def test_hot_keys_are_reduced_before_the_shuffle(skewed):
    dedupe = plan_text(quality.one_row_per_key(skewed, ["k"]))
    assert dedupe.count("WindowGroupLimit") >= 2
    for df in (
        quality.quality_counts(skewed, ["k"]),
        rowsets.signed_counts(skewed, skewed),
        joins.key_overlap(skewed, skewed, ["k"]),
    ):
        assert "partial_" in plan_text(df)
        assert "CartesianProduct" not in plan_text(df) and "NestedLoop" not in plan_text(df)


def test_skewed_results_are_whole(skewed):
    counts = quality.quality_counts(skewed, ["k"]).first()
    assert (counts["processed"], counts["duplicate"], counts["kept"]) == (30_000, 9_999, 20_001)
    overlap = joins.key_overlap(skewed, skewed, ["k"]).first()
    assert overlap["matched_pairs"] == 10_000 * 10_000 + 20_000
    nothing = skewed.limit(0)
    assert rowsets.multiset_difference(skewed, nothing).count() == 30_000


def test_only_needed_columns_are_read(spark, tmp_path):
    spark.range(10).select(
        F.lit("z").alias("pu_zone"), F.current_timestamp().alias("tpep_pickup_datetime"), F.col("id").alias("unused")
    ).write.parquet(str(tmp_path / "t"))
    plan = plan_text(summaries.zone_monthly_demand(spark.read.parquet(str(tmp_path / "t"))))
    assert "ReadSchema: struct<pu_zone:string,tpep_pickup_datetime:timestamp>" in plan


def test_the_planner_chooses_the_join(spark, tmp_path):
    spark.range(1000).withColumn("ts", F.timestamp_seconds("id")).write.parquet(str(tmp_path / "d"))
    dim = spark.read.parquet(str(tmp_path / "d"))
    fact = spark.range(10).select(F.timestamp_seconds("id").alias("at"))
    joined = joins.hour_join(fact, dim, "at", "ts", "d_", "hour")
    assert "BroadcastHashJoin" in plan_text(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan_text(joins.hour_join(fact, dim, "at", "ts", "d_", "hour"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbers_are_rounded_once(spark):
    """Just below an edge, at it, tiny and huge values; the order of adding up does not matter."""
    df = spark.createDataFrame([(0.1249999996,), (0.125,), (1e-12,), (3e18,)], "x double")
    got = [r[0] for r in df.select(measures.shown(F.col("x"), 2)).collect()]
    assert got == [0.12, 0.13, 0.0, 3e18]
    rng = random.Random(1)
    values = [round(rng.uniform(-1000, 1000), 4) for _ in range(3000)] + [1e-11, 2.5e17, -2.5e17, None]
    sums = set()
    for n in range(4):
        rng.shuffle(values)
        frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(n + 1)
        sums.add(tuple(frame.agg(measures.total(F.col("x")), measures.mean(F.col("x"))).first()))
    exact = sum(Fraction(v) for v in values if v is not None)
    assert len({s for s, _ in sums}) <= 2 and all(abs(s - float(exact)) < 64 for s, _ in sums)
    small = [v for v in values if v is not None and abs(v) < 1e15]
    frames = [spark.createDataFrame([(v,) for v in rng.sample(small, len(small))], "x double").repartition(n) for n in (1, 3, 8)]
    found = {tuple(f.agg(measures.total(F.col("x")), measures.mean(F.col("x"))).first()) for f in frames}
    assert len(found) == 1 and found.pop()[0] == pytest.approx(float(sum(map(Fraction, small))), rel=1e-15)
    assert spark.range(0).agg(measures.total(F.col("id")), measures.mean(F.col("id"))).first() == (None, None)


@pytest.mark.parametrize("rising", [True, False])
def test_stored_order(spark, tmp_path, rising):
    rows = [(k % 5 if k % 7 else None, k) for k in range(200)]
    df = spark.createDataFrame(rows, "a int, b int")
    keys = [("a", rising), ("b", True)]
    order = [F.col("a").asc() if rising else F.col("a").desc(), F.col("b").asc()]
    df.repartitionByRange(4, *order).sortWithinPartitions(*order).write.parquet(str(tmp_path / "sorted"))
    df.repartition(3).write.parquet(str(tmp_path / "mixed"))
    ok = stored_order(spark.read.parquet(str(tmp_path / "sorted")), keys).first()
    assert (ok.row_count, ok.out_of_order) == (200, 0) and ok.files > 1
    rank = lambda r: ((r.a is not None, r.a or 0) if rising else (r.a is None, -(r.a or 0)), r.b)
    mixed = spark.read.parquet(str(tmp_path / "mixed"))
    stored = [r for f in sorted((tmp_path / "mixed").glob("*.parquet")) for r in spark.read.parquet(str(f)).coalesce(1).collect()]
    wrong = sum(rank(x) > rank(y) for x, y in zip(stored, stored[1:]))
    assert stored_order(mixed, keys).first().out_of_order == wrong > 50
    assert tuple(stored_order(mixed.where("b < 0"), keys).first()) == (0, 0, 0)
