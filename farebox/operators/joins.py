"""Enrichment joins and key overlap.

No join here broadcasts a side unless its caller says so. A dimension that comes from a stored
table has its real size known to the planner, which broadcasts it below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges; in
that case AQE splits a fact key that is too large (the fact is always the
outer, splittable side). Dimensions that are computed on the fly go through
``scratch.stage`` first to get a measured size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from farebox.functions.measures import mean
from farebox.functions.timeparts import hour_bucket
from farebox.operators.conform import prefix_columns


def _flagged_left_join(fact: DataFrame, dim: DataFrame, condition: Column, flag: str | None) -> DataFrame:
    """Left join; ``flag`` says whether the dimension had a row, whatever its values are."""
    if flag is None:
        return fact.join(dim, condition, "left")
    joined = fact.join(dim.withColumn(flag, F.lit(True)), condition, "left")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def hour_join(
    fact: DataFrame,
    dim: DataFrame,
    event_time: str,
    dim_time: str,
    prefix: str,
    hour_column: str,
    how: str = "left",
    hint: str | None = None,
) -> DataFrame:
    """Attach the dimension row of the hour an event falls into.

    ``hint`` asks for a join strategy, ``merge`` or ``broadcast``; without one the planner chooses by
    the size of the dimension. Ask for ``broadcast`` only where that size is known to stay small.
    """
    side = prefix_columns(dim, prefix)
    flag = f"{prefix}matched"
    fact = fact.withColumn(hour_column, hour_bucket(F.col(event_time)))
    if hint:
        side = side.hint(hint)
    condition = F.col(hour_column) == F.col(prefix + dim_time)
    if how == "left":
        return _flagged_left_join(fact, side, condition, flag).drop(prefix + dim_time)
    return fact.join(side, condition, how).drop(prefix + dim_time)


def lookup_join(
    fact: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Attach ``columns`` (lookup name -> new name); use it once per role of the lookup."""
    side = lookup.select(
        F.col(lookup_key).alias("_lookup_key"), *[F.col(c).alias(new) for c, new in columns.items()]
    )
    return fact.join(side, F.col(fact_key) == F.col("_lookup_key"), "left").drop("_lookup_key")


def summary_of(name: str, kind: T.DataType) -> Column:
    """What stands for several values of a column: their mean, whether any holds, the latest, or the only one.

    Numbers are averaged. Times give the latest and flags are true if one is. Of texts the value counts
    that all rows agree on; where they differ there is none.
    """
    c = F.col(name)
    if isinstance(kind, T.NumericType):
        return mean(c).alias(name)
    if isinstance(kind, T.BooleanType):
        return F.bool_or(c).alias(name)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.max(c).alias(name)
    return F.when(F.min(c) == F.max(c), F.min(c)).alias(name)


def reduce_per_area_hour(
    measurements: DataFrame, area: str, time: str, measures: Sequence[str] | None = None
) -> DataFrame:
    """One row per area and hour: a summary of each measure by its type, and the number of measurements.

    Several stations may report for one area and hour; joining them as they are
    would repeat each fact row once per station. Without ``measures`` all columns are taken.
    """
    kinds = {f.name: f.dataType for f in measurements.schema.fields if f.name not in (area, time)}
    wanted = kinds if measures is None else measures
    return (
        measurements.filter(F.col(area).isNotNull() & F.col(time).isNotNull())
        .groupBy(area, time)
        .agg(*[summary_of(m, kinds[m]) for m in wanted], F.count("*").alias("measurements"))
    )


def area_hour_join(
    fact: DataFrame,
    measurements: DataFrame,
    fact_area: str,
    fact_hour: str,
    area: str,
    time: str,
    prefix: str,
) -> DataFrame:
    """Attach measurements by area and hour. A fact row appears once per matching measurement row."""
    side = prefix_columns(measurements, prefix)
    condition = (F.col(fact_area) == F.col(prefix + area)) & (F.col(fact_hour) == F.col(prefix + time))
    joined = _flagged_left_join(fact, side, condition, f"{prefix}matched")
    return joined.drop(prefix + area, prefix + time)


def key_overlap(update: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows of the update, those whose key exists, and matching row pairs.

    Both sides are counted per key before they meet, so a frequent key costs one
    row per side and its pairs are multiplied, not produced. NULL keys do not match.
    """
    left = update.groupBy(*keys).agg(F.count("*").alias("update_copies"))
    right = existing.groupBy(*keys).agg(F.count("*").alias("existing_copies"))
    return (
        left.join(right, list(keys), "left")
        .agg(
            F.coalesce(F.sum("update_copies"), F.lit(0)).alias("update_rows"),
            F.coalesce(
                F.sum(F.when(F.col("existing_copies").isNotNull(), F.col("update_copies"))), F.lit(0)
            ).alias("matched_rows"),
            F.coalesce(F.sum(F.col("update_copies") * F.col("existing_copies")), F.lit(0)).alias("matched_pairs"),
        )
    )
