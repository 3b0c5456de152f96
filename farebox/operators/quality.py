"""Key and duplicate checks.

All of these shuffle at most one row per key and map task: the window below
plans a group limit before the exchange, and the aggregates combine on the map
side. A key that holds a third of the table is therefore no hot spot.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _nulls_last(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(keys))


def one_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Keep the first row of each key.

    ``order`` ranks the rows of a key; the remaining columns break ties, so the
    survivor never depends on which task came first.
    """
    rest = [c for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *_nulls_last(rest or keys))
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def quality_gate(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """With keys: complete keys only, one row each. Without: exact copies removed."""
    if not keys:
        return distinct_rows(df)
    return one_row_per_key(drop_null_keys(df, keys), keys, order)


COPIES = "_copies"


def graded_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, as ``one_row_per_key`` chooses it, and in ``_copies`` how many rows had that key.

    Keys with a NULL are there too, for the caller to count and put aside (``null_key``). So one
    grouping gives the rows to keep and everything there is to count. Without keys, whole rows are the
    key. Rows are reduced per task before they are shuffled.
    """
    if not keys:
        return df.groupBy(*df.columns).agg(F.count("*").alias(COPIES))
    rest = [c for c in df.columns if c not in keys]
    # NULL after any value: the flag in front decides.
    ranked = [part for c in rest for part in (F.col(c).isNull().alias(f"null_{c}"), F.col(c).alias(c))]
    first = [F.min(F.struct(*ranked)).alias("_first")] if rest else []
    groups = df.groupBy(*keys).agg(*first, F.count("*").alias(COPIES))
    return groups.select(*[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns], COPIES)


def null_key(keys: Sequence[str]) -> Column:
    """Whether a row lacks a part of its key."""
    return functools.reduce(operator.or_, [F.col(k).isNull() for k in keys], F.lit(False))


def quality_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows processed, rejected for a NULL key, rejected as duplicate, and kept.

    Counted from the data instead of with accumulators, which count a task
    twice when its output is lost and it runs again. Only the key columns are
    read (all of them without a key).
    """
    groups = df.groupBy(*(keys or df.columns)).agg(F.count("*").alias("copies"))
    lacking = null_key(keys)
    return (
        groups.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("processed"),
            F.coalesce(F.sum(F.when(lacking, F.col("copies"))), F.lit(0)).alias("null_key"),
            F.count_if(~lacking).alias("kept"),
        )
        .withColumn("duplicate", F.col("processed") - F.col("null_key") - F.col("kept"))
        .select("processed", "null_key", "duplicate", "kept")
    )
