"""Building update data from existing data: samples, shifts, spines and grids."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from farebox.operators.ranking import first_rows
from farebox.operators.rowsets import repeat_rows, union_all
from farebox.sources.scratch import stage


# Lot digits added per step of a count: 4096 groups, few enough to combine well in each task.
_DIGITS = 3
# Rows of a group that are ordered together, on average; the number of groups follows the rows.
_GROUP_ROWS = 1024


def _digits(rows: int) -> int:
    """Leading lot digits that tell groups of about ``_GROUP_ROWS`` rows apart, in whole steps."""
    steps = math.ceil(math.log(max(rows / _GROUP_ROWS, 2), 16**_DIGITS))
    return _DIGITS * min(steps, 4)


def quota(df: DataFrame, share: float) -> int:
    """Number of rows that make up ``share`` of the frame, rounded up."""
    # As decimals: the product of doubles may lie just above a whole number.
    return math.ceil(Decimal(df.count()) * Decimal(str(share)))


def row_draw(columns: Sequence[str], seed: int) -> Column:
    """Reproducible 32-hex-digit lot of a row: MD5 of the seed and the columns."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def sample_with_replacement(df: DataFrame, n: int, seed: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows, each drawn from all rows; none from an empty frame.

    Rows have a position in the order of their lots: rows with the same first lot digits are numbered on
    their own, after the rows of the groups before. There are as many groups as the rows need, and the
    counts before them are added up in two levels. Draws are hashed onto positions and meet the rows in an
    equi-join. ``columns`` draw the lot (default: all) and should tell rows apart.
    """
    names, size = df.columns, df.count()
    if not size:
        return df
    drawn = df.withColumn("_lot", row_draw(columns or names, seed))
    drawn = drawn.withColumn("_group", F.substring("_lot", 1, _digits(size)))
    groups = drawn.groupBy("_group").agg(F.count("*").alias("_rows")).withColumn("_top", F.substring("_group", 1, _DIGITS))
    # At most 4096 tops by construction, so one task may add them up; below each, its groups on their own.
    earlier = Window.orderBy("_top").rowsBetween(Window.unboundedPreceding, -1)
    tops = groups.groupBy("_top").agg(F.sum("_rows").alias("_all"))
    tops = tops.select("_top", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_base"))
    before = Window.partitionBy("_top").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    below = groups.withColumn("_below", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    starts = below.join(tops, "_top").select("_group", (F.col("_base") + F.col("_below")).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_group").orderBy("_lot", *names))
    placed = drawn.withColumn("_inside", inside).join(starts, "_group")
    placed = placed.select(*names, (F.col("_start") + F.col("_inside") - 1).alias("_at"))
    lot = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("id").cast("string"))), 1, 15), 16, 10)
    draws = df.sparkSession.range(n).groupBy((lot.cast("long") % F.lit(size)).alias("_at")).agg(F.count("*").alias("_take"))
    return repeat_rows(placed.join(draws, "_at").drop("_at"), "_take")


def sample_exact(df: DataFrame, n: int, seed: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows (or all): those with the smallest lots.

    Lots are spread evenly, so those of the sample lie below a bound that follows from ``n`` and the number
    of rows, with some to spare. The rows below it are stored: the frame is counted and then read once, and
    the exact cut is found in what was stored, by counting rows per leading lot digits. Only the group
    around the cut is ordered. ``columns`` draw the lot (default: all) and must tell different rows apart;
    exact copies are counted, not sorted.
    """
    size = df.count()
    if n >= size or not n:
        return df if n else df.limit(0)
    names = df.columns
    drawn = df.withColumn("_lot", row_draw(columns or names, seed))
    # Six standard deviations more than wanted; where many copies share a lot that may not do, so it is widened.
    share, stored, found = (n + 6 * math.sqrt(n) + 20) / size, drawn, -1
    while found < n:
        bound = f"{min(math.ceil(share * 16**12), 16**12 - 1):012x}"
        stored = drawn if share >= 1 else drawn.filter(F.substring("_lot", 1, 12) <= bound)
        stored = stage(stored, "drawn")
        found, share = stored.count(), 8 * share
    low, need = _cut_prefix(stored, n, _digits(found))
    head = stored.filter(F.substring("_lot", 1, len(low)) < low).select(*names)
    edge = stored.filter(F.col("_lot").startswith(low)).groupBy("_lot", *names).agg(F.count("*").alias("_copies"))
    order = Window.orderBy("_lot", *names).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_copies").over(order), F.lit(0))
    take = F.least(F.col("_copies"), F.greatest(F.lit(need) - before, F.lit(0)))
    tail = repeat_rows(edge.withColumn("_take", take).drop("_copies", "_lot"), "_take")
    return head.unionByName(tail)


def _cut_prefix(drawn: DataFrame, n: int, depth: int) -> tuple[str, int]:
    """Lot prefix of ``depth`` digits in which the ``n``-th smallest row lies, and how many of its rows are wanted."""
    counts = drawn.groupBy(F.substring("_lot", 1, depth).alias("group")).agg(F.count("*").alias("rows"))
    counts, prefix = stage(counts, "lots"), ""
    while len(prefix) < depth:
        groups = counts.filter(F.col("group").startswith(prefix))
        # At most 4096 groups by construction, so one task may order them.
        some = groups.groupBy(F.substring("group", 1, len(prefix) + _DIGITS).alias("prefix")).agg(F.sum("rows").alias("rows"))
        upto = F.sum("rows").over(Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
        cut = some.withColumn("upto", upto).filter(F.col("upto") >= n).orderBy("prefix").first()
        prefix, n = cut["prefix"], n - cut["upto"] + cut["rows"]
    return prefix, n


def inject_duplicates(new_rows: DataFrame, copies: DataFrame, shuffle_seed: int | None = None) -> DataFrame:
    """New rows plus exact copies of old ones; optionally in random order."""
    both = union_all([new_rows, copies])
    return both if shuffle_seed is None else both.orderBy(F.rand(shuffle_seed))


def shift_past_latest(df: DataFrame, start: str, end: str, offset_seconds: Column) -> DataFrame:
    """Move each row to ``offset_seconds`` after the latest ``start``; durations stay."""
    latest = df.agg(F.max(start).alias("latest")).scalar()
    moved = latest + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), offset_seconds.cast("decimal(18,6)"))
    return df.withColumns({start: moved, end: moved + (F.col(end) - F.col(start))})


def recompute_total(df: DataFrame, parts: Sequence[str], output: str, digits: int = 2) -> DataFrame:
    """``output`` = sum of the parts that exist; a NULL part counts as zero."""
    total = F.lit(0).cast("decimal(18,4)")
    for p in parts:
        if p in df.columns:
            total = total + F.coalesce(F.col(p).cast("decimal(18,4)"), F.lit(0))
    return df.withColumn(output, F.round(total, digits).cast("double"))


def tail_statistics(df: DataFrame, order: Sequence[Column], n: int, measures: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of the last ``n`` rows per measure; 0 and 1 when nothing is there."""
    tail = first_rows(df, order, n)
    entries = []
    aggregates = []
    for m in measures:
        value = F.col(m).try_cast("double")
        aggregates += [F.avg(value).alias(f"{m}_avg"), F.stddev_samp(value).alias(f"{m}_std")]
        aggregates.append(F.count(value).alias(f"{m}_n"))
        entries.append(
            F.struct(
                F.lit(m).alias("measure"),
                F.coalesce(F.col(f"{m}_avg"), F.lit(0.0)).alias("mean"),
                F.when(F.col(f"{m}_n") == 0, F.lit(1.0)).otherwise(F.col(f"{m}_std")).alias("std"),
            )
        )
    return tail.agg(*aggregates).select(F.inline(F.array(*entries)))


def hourly_spine(df: DataFrame, time: str, hours: int) -> DataFrame:
    """The ``hours`` hours after the latest ``time``, with their date parts."""
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    last = F.col("last")
    span = F.sequence(last + hour, last + F.make_dt_interval(F.lit(0), F.lit(hours)), hour)
    spine = df.agg(F.max(time).alias("last")).filter(last.isNotNull()).select(F.explode(span).alias("timestamp"))
    return spine.select(
        "timestamp",
        F.year("timestamp").alias("year"),
        F.month("timestamp").alias("month"),
        F.day("timestamp").alias("day"),
        F.hour("timestamp").alias("hour"),
    )


def stations(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` distinct stations in the order of their columns."""
    return first_rows(df.select(*columns).dropDuplicates(), [F.asc_nulls_last(c) for c in columns], n)


def station_grid(station_rows: DataFrame, start: Column, hours: int, output: str = "timestamp") -> DataFrame:
    """Every station with every hour from ``start`` on; each row makes its own hours, no join."""
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    span = F.sequence(start, start + F.make_dt_interval(F.lit(0), F.lit(hours - 1)), hour)
    return station_rows.withColumn(output, F.explode(span))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Default values for missing key parts."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def latest_rows(df: DataFrame, time: str) -> DataFrame:
    """Rows of the latest ``time`` in the frame, found by value instead of by file position."""
    return df.filter(F.col(time) == df.agg(F.max(time)).scalar())
