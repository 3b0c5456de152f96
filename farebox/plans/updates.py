"""Incremental loads: insert what is new, never twice."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from farebox.operators.conform import (
    align_to,
    column_types,
    conform_text,
    derive_values,
    schema_diff,
    standardize_columns,
)
from farebox.operators.merge import rows_with_new_key
from farebox.operators.quality import null_key, quality_gate
from farebox.operators.rowsets import novel_rows
from farebox.sources.descriptor import DatasetSpec
from farebox.sources.scratch import staged
from farebox.sources.tables import Table


@dataclass(frozen=True)
class UpdateRecord:
    """What an incremental load did."""

    dataset: str
    rows_in_update: int
    null_keys: int
    duplicates: int
    inserted: int
    schema_change: str
    elapsed_s: float


UPDATE_LOG_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("rows_in_update", T.LongType()),
        T.StructField("null_keys", T.LongType()),
        T.StructField("duplicates", T.LongType()),
        T.StructField("inserted", T.LongType()),
        T.StructField("schema_change", T.StringType()),
        T.StructField("elapsed_s", T.DoubleType()),
    ]
)


def conform_update(
    raw: DataFrame,
    spec: DatasetSpec,
    target: T.StructType,
    new_types: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Conform an update file to the types of the stored table; new columns are allowed."""
    text = conform_text(standardize_columns(raw), spec)
    typed = derive_values(align_to(text, spec.struct(), new_types), spec)
    return align_to(typed, target, new_types)


def schema_change_text(target: T.StructType, update: T.StructType) -> str:
    """Columns the update adds (+) or has in another type (~) than the table, in order; empty if none.

    A column the update lacks is no change of the table: it is NULL in the new rows.
    """
    marks = {"added": "+", "retyped": "~"}
    found = schema_diff(column_types(target), column_types(update))
    return " ".join(marks[c.change] + c.column for c in found if c.change in marks)


def merge_insert_only(source: DataFrame, existing: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows to insert: complete keys, one row per key, key not stored yet."""
    return rows_with_new_key(quality_gate(source, keys), existing, keys)


def load_update(
    table: Table,
    raw: DataFrame,
    spec: DatasetSpec,
    new_types: Mapping[str, T.DataType] | None = None,
    event_time: str | None = None,
    batch: int | None = None,
    history: DataFrame | None = None,
) -> UpdateRecord:
    """Load an update as the next batch (or as ``batch``, which may be repeated).

    With a primary key, rows whose key is stored are skipped. Without one, rows
    that are stored as they are count as duplicates; ``event_time`` limits the
    comparison to the time span of the update and ``history`` may widen it
    to more than ``table``.
    """
    started = time.monotonic()
    if batch is None:
        batch = (table.version() or 0) + 1
    target = table.schema(as_of=batch - 1)
    update = conform_update(raw, spec, target, new_types)
    with staged(update, "update") as source:
        counted = source.agg(F.count("*"), F.count_if(null_key(spec.primary_keys)))
        rows, null_keys = counted.first()
        if spec.primary_keys:
            fresh = merge_insert_only(source, table.read(as_of=batch - 1), spec.primary_keys)
        else:
            past = table.read(as_of=batch - 1) if history is None else history
            fresh = novel_rows(source, _with_columns_of(past, source), event_time)
        table.write_batch(fresh, batch)
    inserted = table.read(as_of=batch, since=batch - 1).count()
    return UpdateRecord(
        dataset=spec.name,
        rows_in_update=rows,
        null_keys=null_keys,
        duplicates=rows - null_keys - inserted,
        inserted=inserted,
        schema_change=schema_change_text(target, update.schema),
        elapsed_s=round(time.monotonic() - started, 2),
    )


def _with_columns_of(past: DataFrame, update: DataFrame) -> DataFrame:
    """History seen through the update's columns; a column it lacks is NULL."""
    have = set(past.columns)
    return past.select(
        *[
            F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in update.schema.fields
        ]
    )


def update_log(spark: SparkSession, records: Iterable[UpdateRecord]) -> DataFrame:
    rows = [tuple(asdict(r)[f] for f in UPDATE_LOG_SCHEMA.names) for r in records]
    return spark.createDataFrame(rows, UPDATE_LOG_SCHEMA)
