"""Checking the order of stored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

def _after(earlier: Column, later: Column, order: Sequence[tuple[str, bool]]) -> Column:
    """Whether the struct ``earlier`` belongs behind ``later``. A NULL is before any value, and behind it if falling."""
    wrong, alike = F.lit(False), F.lit(True)
    for name, rising in order:
        a, b = earlier[name], later[name]
        low, high = (b, a) if rising else (a, b)
        less = F.coalesce(low < high, low.isNull() & high.isNotNull())
        wrong = wrong | (alike & less)
        alike = alike & a.eqNullSafe(b)
    return wrong


def stored_order(stored: DataFrame, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """One row: row_count, files, and out_of_order, the steps from a row to the next that go the wrong way.

    ``stored`` is read from Parquet files as they are, in order of their names, and ``order`` lists columns
    and whether they rise. Inside of a file rows are compared with the row before; of each file its first
    and last row, one record, are compared with its neighbours. So no more than one file meets in one task.
    Nothing is out of order in an empty table.
    """
    key = F.struct(*[F.col(c) for c, _ in order])
    rows = stored.select(
        key.alias("key"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    inside = Window.partitionBy("file").orderBy("at")
    steps = rows.withColumn("before", F.lag("key").over(inside))
    wrong = F.col("before").isNotNull() & _after(F.col("before"), F.col("key"), order)
    files = steps.groupBy("file").agg(
        F.count("*").alias("rows"),
        F.count_if(wrong).alias("wrong"),
        F.min_by("key", "at").alias("first"),
        F.max_by("key", "at").alias("last"),
    )
    previous = F.lag("last").over(Window.orderBy("file"))
    bounds = files.withColumn("previous", previous)
    across = F.col("previous").isNotNull() & _after(F.col("previous"), F.col("first"), order)
    return bounds.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        F.count("*").alias("files"),
        (F.coalesce(F.sum("wrong"), F.lit(0)) + F.count_if(across)).alias("out_of_order"),
    )
