import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from farebox.operators import augment as a


@pytest.fixture
def copies(spark):
    """A third of all rows are copies of one row."""
    return spark.range(0, 3000, 1, 4).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("x"))


@pytest.mark.parametrize("n", [0, 1, 700, 1500, 2999, 3000, 5000])
def test_sample_exact_size(copies, n):
    got = Counter(r["x"] for r in a.sample_exact(copies, n, 7).collect())
    assert sum(got.values()) == min(n, 3000)
    assert not got - Counter(r["x"] for r in copies.collect())


def test_sample_exact_is_the_smallest_lots(spark):
    import hashlib

    df = spark.range(0, 2000, 1, 5)
    lots = sorted(range(2000), key=lambda i: hashlib.md5(f"3|{i}".encode()).hexdigest())
    for n in (1, 17, 500):
        assert {r["id"] for r in a.sample_exact(df, n, 3, ["id"]).collect()} == set(lots[:n])


def test_depth_follows_the_rows(spark, copies, monkeypatch):
    assert [a._digits(n) for n in (0, 1000, 4_000_000, 5_000_000, 10**10, 10**11, 10**15)] == [3, 3, 3, 6, 6, 9, 12]
    monkeypatch.setattr(a, "_GROUP_ROWS", 1 / 4096)
    assert a._digits(3000) == 6
    reads, stage = [], a.stage
    monkeypatch.setattr(a, "stage", lambda df, label: (reads.append(label), stage(df, label))[1])
    test_sample_exact_is_the_smallest_lots(spark)
    assert reads == ["drawn", "lots"] * 3, "the frame was read once each time"
    for n in (1, 700, 2999):
        test_sample_exact_size(copies, n)
    assert a.sample_with_replacement(copies, 5000, 3).count() == 5000


@pytest.mark.parametrize("rows", [1024, 1 / 4096])
def test_quota_and_replacement(spark, monkeypatch, rows):
    monkeypatch.setattr(a, "_GROUP_ROWS", rows)
    df = spark.range(1001)
    assert a.quota(df, 0.015) == math.ceil(1001 * 0.015)
    got = Counter(r["id"] for r in a.sample_with_replacement(df, 2000, 1).collect())
    assert sum(got.values()) == 2000 and set(got) <= set(range(1001)) and max(got.values()) > 1
    assert a.sample_with_replacement(df, 0, 1).count() == 0
    assert a.sample_with_replacement(df.limit(0), 5, 1).count() == 0


def test_shift_keeps_durations(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS s, TIMESTAMP '2024-01-01 00:10:00' AS e, 86400 AS off")
    out = a.shift_past_latest(df, "s", "e", F.col("off")).select(F.col("s").cast("string"), F.col("e").cast("string"))
    assert tuple(out.first()) == ("2024-01-02 00:00:00", "2024-01-02 00:10:00")


def test_recompute_total(spark):
    df = spark.createDataFrame([(1.1, None, 9.0), (2.25, 0.1, 9.0)], "a double, b double, total double")
    assert [r["total"] for r in a.recompute_total(df, ["a", "b", "absent"], "total").collect()] == [1.1, 2.35]


def test_tail_statistics(spark):
    df = spark.createDataFrame([(1, 100.0, None), (2, 1.0, None), (3, 3.0, None)], "t int, x double, y double")
    got = {r["measure"]: (r["mean"], r["std"]) for r in a.tail_statistics(df, [F.desc("t")], 2, ["x", "y"]).collect()}
    assert got["x"] == (2.0, pytest.approx(math.sqrt(2)))
    assert got["y"] == (0.0, 1.0)


def test_spine_and_grid(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-31 23:00:00' AS t")
    spine = a.hourly_spine(df, "t", 2).select("year", "month", "day", "hour").collect()
    assert [tuple(r) for r in spine] == [(2024, 2, 1, 0), (2024, 2, 1, 1)]
    assert a.hourly_spine(df.limit(0), "t", 2).count() == 0
    grid = a.station_grid(spark.createDataFrame([(1,), (2,)], "s int"), F.lit("2024-01-01").cast("timestamp"), 24)
    assert grid.count() == 48


def test_latest_rows_and_defaults(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (3, None)], "t int, x string")
    assert a.latest_rows(df, "t").count() == 2
    assert [r["x"] for r in a.fill_defaults(df, {"x": "z"}).orderBy("t", "x").collect()] == ["a", "b", "z"]


def test_inject_duplicates(spark):
    df = spark.range(5)
    assert a.inject_duplicates(df, df.filter("id = 1"), shuffle_seed=1).groupBy("id").count().filter("count = 2").count() == 1
