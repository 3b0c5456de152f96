"""Ranking, ordering and previous-row differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each group. ``order`` must be total, or the winner of a tie is arbitrary.

    Planned with a group limit before the shuffle, so each task sends one row
    per group.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def change_from_previous(summary: DataFrame, order: str, value: str) -> DataFrame:
    """Value of the previous row and the difference to it; NULL on the first row.

    The window is global and runs in one task: give it an aggregate with one
    row per ``order`` value, never raw events.
    """
    window = Window.orderBy(order)
    return summary.withColumn("previous_count", F.lag(value).over(window)).withColumn(
        "difference", F.col(value) - F.col("previous_count")
    )


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of a total order; each task keeps ``n`` rows before they meet."""
    return df.orderBy(*order).limit(n)
