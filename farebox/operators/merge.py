"""Merging new rows into stored tables without a merge statement."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def key_condition(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False) -> Column:
    """Equality of all keys; ``null_safe`` lets NULL match NULL."""
    pairs = [(left[k], right[k]) for k in keys]
    same = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return functools.reduce(operator.and_, same)


def rows_with_new_key(source: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key ``existing`` does not have (insert when not matched).

    ``source`` must have passed the quality gate. History is cut down to the keys of the source first,
    so only keys that meet go on; the planner broadcasts the source's keys if their size
    allows it, and then nothing of history is shuffled but the few keys found. They are made
    distinct map-side, so a hot key does not reach one task.
    """
    names = list(keys)
    seen = existing.select(*names).join(source.select(*names), names, "left_semi").distinct()
    return source.join(seen, names, "left_anti")


def fill_unmatched(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[tuple[str, str]],
    columns: Sequence[str],
    matched_flag: str,
    replace: bool = False,
) -> DataFrame:
    """Give target rows that had no match the values of ``source``.

    ``on`` pairs target and source columns; ``source`` must hold one row per key.
    Only rows whose flag is false change, so a matched row with NULL values is
    left alone and a second run does nothing. With ``replace`` matched rows whose key is in
    ``source`` get its values too: right where they are a summary that has changed.
    """
    # Unmatched target rows with a key the source lacks keep their values too.
    side = source.select(
        *[F.col(s).alias(f"_key_{s}") for _, s in on],
        *[F.col(c).alias(f"_new_{c}") for c in columns],
        F.lit(True).alias("_found"),
    )
    condition = F.lit(True) if replace else ~F.col(matched_flag)
    for t, s in on:
        condition = condition & (F.col(t) == F.col(f"_key_{s}"))
    joined = target.join(side, condition, "left")
    have = set(target.columns)
    updates = {
        c: F.when(F.col("_found"), F.col(f"_new_{c}")).otherwise(F.col(c) if c in have else F.lit(None))
        for c in columns
    }
    updates[matched_flag] = F.col(matched_flag) | F.coalesce(F.col("_found"), F.lit(False))
    filled = joined.withColumns(updates)
    return filled.select(*target.columns, *[c for c in columns if c not in have])
