"""Row-set algebra that treats NULL as equal to NULL.

Everything is grouping on whole rows. Grouping combines on the map side, so a
row with very many copies travels once per map task; a join on all columns
would send all of them to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

_COPIES = "_copies"
# Rows made per generator row when copies are written out again.
_CHUNK = 65536


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name, copies kept."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Each row as often as its ``copies`` column says.

    The count is cut into chunks that are spread over all tasks before they are
    expanded, so one very frequent row is written by many tasks.
    """
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(copies) - 1) / _CHUNK))
    return (
        df.filter(F.col(copies) > 0)
        .withColumn("_chunk", F.explode(chunks))
        .withColumn("_size", F.least(F.lit(_CHUNK).cast("bigint"), F.col(copies) - F.col("_chunk") * _CHUNK))
        .hint("rebalance")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size"))))
        .drop("_chunk", "_size", "_copy", copies)
    )


def signed_counts(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows with (copies in ``left``) - (copies in ``right``), where these differ."""
    names = list(columns or left.columns)
    both = (
        left.select(*names, F.lit(1).cast("bigint").alias(_COPIES))
        .unionByName(right.select(*names, F.lit(-1).cast("bigint").alias(_COPIES)))
    )
    return both.groupBy(*names).agg(F.sum(_COPIES).alias(_COPIES)).filter(F.col(_COPIES) != 0)


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` minus ``right``, each copy counted."""
    return left.exceptAll(right)


def difference_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: copies only in ``left`` and copies only in ``right``; both 0 when the frames are equal."""
    diff = signed_counts(left, right)
    return diff.agg(
        F.coalesce(F.sum(F.greatest(F.col(_COPIES), F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col(_COPIES), F.lit(0))), F.lit(0)).alias("only_right"),
    )


def frames_equal(left: DataFrame, right: DataFrame) -> bool:
    row = difference_counts(left, right).first()
    return row["only_left"] == 0 and row["only_right"] == 0


def _suspects(history: DataFrame, update: DataFrame, names: list[str]) -> DataFrame:
    """Rows of ``history`` whose row hash occurs in ``update``; the hash only narrows, it never decides.

    When the update's hashes are small enough the planner broadcasts them and
    history is filtered where it is read, without a shuffle.
    """
    row_hash = F.xxhash64(*names)
    wanted = update.select(row_hash.alias("_hash")).distinct()
    return (
        history.select(*names)
        .withColumn("_hash", row_hash)
        .join(wanted, "_hash", "left_semi")
        .drop("_hash")
    )


def novel_rows(update: DataFrame, history: DataFrame, event_time: str | None = None) -> DataFrame:
    """Distinct rows of ``update`` that ``history`` does not have, compared on all columns of ``update``.

    ``event_time`` limits history to the time span of the update, which the
    scan uses to skip files; rows without a time are always compared.
    """
    names = update.columns
    past = history.select(*names)
    if event_time is not None:
        # As text, since Python would read the instants in the driver's own time zone.
        low, high = update.agg(*[f(event_time).cast("string") for f in (F.min, F.max)]).first()
        t, kind = F.col(event_time), update.schema[event_time].dataType
        span = t.between(F.lit(low).cast(kind), F.lit(high).cast(kind))
        past = past.filter(t.isNull() if low is None else t.isNull() | span)
    past = _suspects(past, update, names)
    tagged = (
        update.withColumn("_known", F.lit(0))
        .unionByName(past.withColumn("_known", F.lit(1)))
    )
    return (
        tagged.groupBy(*names)
        .agg(F.max("_known").alias("_known"))
        .filter(F.col("_known") == 0)
        .drop("_known")
    )


def snapshot_diff(current: DataFrame, earlier: DataFrame) -> DataFrame:
    """Distinct rows of ``current`` that are not in the ``earlier`` snapshot.

    Compared on the earlier snapshot's columns; columns added since then are
    carried along. A row counts as new when its number of copies grew. For a
    managed table use ``Table.read(since=version)``, which compares nothing.
    """
    shared = list(earlier.columns)
    grown = signed_counts(current, earlier, shared).filter(F.col(_COPIES) > 0).drop(_COPIES)
    if set(shared) == set(current.columns):
        return grown.select(*current.columns)
    rows = current.dropDuplicates()
    grown = grown.toDF(*[f"_g_{c}" for c in shared])
    condition = None
    for c in shared:
        same = F.col(c).eqNullSafe(F.col(f"_g_{c}"))
        condition = same if condition is None else condition & same
    return rows.join(grown, condition, "left_semi")
