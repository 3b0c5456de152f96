"""Descriptor-driven ingestion of raw files into managed tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from farebox.operators.conform import (
    cast_declared,
    conform_text,
    derive_values,
    require_schema,
    schema_fingerprint,
    standardize_columns,
)
from farebox.operators.quality import COPIES, graded_rows, null_key
from farebox.sources.descriptor import DatasetSpec
from farebox.sources.readers import read_raw
from farebox.sources.tables import WRITE, Change, Table


@dataclass(frozen=True)
class IngestRecord:
    """What a load did."""

    dataset: str
    processed_records: int
    rejected_records: int
    null_key_records: int
    duplicate_records: int
    final_records: int
    execution_time_seconds: float
    schema_version: str


INGEST_LOG_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("processed_records", T.LongType()),
        T.StructField("rejected_records", T.LongType()),
        T.StructField("null_key_records", T.LongType()),
        T.StructField("duplicate_records", T.LongType()),
        T.StructField("final_records", T.LongType()),
        T.StructField("execution_time_seconds", T.DoubleType()),
        T.StructField("schema_version", T.StringType()),
    ]
)


def conform(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Raw frame to checked, typed frame: one lazy chain of projections.

    Texts are trimmed, code widths restored and declared timestamp formats
    parsed before the declared types are applied; the schema is checked on the
    declared columns, then derived columns and booleans are made.
    """
    df = cast_declared(conform_text(standardize_columns(raw), spec), spec)
    return derive_values(require_schema(df, spec), spec)


_COUNTED = T.StructType([T.StructField(COPIES, T.LongType())])


def ingest_into(change: Change, df: DataFrame, spec: DatasetSpec, batch: int) -> IngestRecord:
    """Conform, check and store one frame as a batch of a change that is published later.

    The frame is read once. One grouping by key gives the rows to keep with the number of their copies
    and those without a key; both are written by the same job, and the counts are taken from what it wrote.
    """
    started = time.monotonic()
    conformed = conform(df, spec)
    graded = graded_rows(conformed, spec.primary_keys)
    aside = null_key(spec.primary_keys) if spec.primary_keys else None
    rows, rejects = change.put(graded, batch, beside=[COPIES], aside=aside)
    counted = change.stored(batch, [rows, rejects], _COUNTED).agg(
        F.count_if(F.col(WRITE) == rows).alias("kept"),
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("processed"),
        F.coalesce(F.sum(F.when(F.col(WRITE) == rejects, F.col(COPIES))), F.lit(0)).alias("null_key"),
    )
    kept, processed, lacking = counted.first()
    change.discard(batch, rejects)
    return IngestRecord(
        dataset=spec.name,
        processed_records=processed,
        rejected_records=processed - kept,
        null_key_records=lacking,
        duplicate_records=processed - lacking - kept,
        final_records=kept,
        execution_time_seconds=round(time.monotonic() - started, 2),
        schema_version=schema_fingerprint(conformed.schema),
    )


def ingest_frame(df: DataFrame, spec: DatasetSpec, table: Table, batch: int = 0) -> IngestRecord:
    """Conform, check and store one frame as a batch of ``table``."""
    change = table.change()
    record = ingest_into(change, df, spec, batch)
    change.publish()
    return record


def ingest_dataset(spark: SparkSession, spec: DatasetSpec, table: Table, batch: int = 0) -> IngestRecord:
    return ingest_frame(read_raw(spark, spec), spec, table, batch)


def ingest_all(
    spark: SparkSession, specs: Iterable[DatasetSpec], table_of: Callable[[str], Table]
) -> list[IngestRecord]:
    """Load every dataset in full, in place of what its table held; those that share a table become its batches.

    A table shows its old rows until all of its datasets are loaded, and from then on only the new ones.
    """
    changes: dict[str, Change] = {}
    records = []
    for spec in specs:
        table = table_of(spec.name)
        if table.path not in changes:
            changes[table.path] = table.change()
            changes[table.path].start_at(changes[table.path].next_batch())
        change = changes[table.path]
        records.append(ingest_into(change, read_raw(spark, spec), spec, change.next_batch()))
    for change in changes.values():
        change.publish()
    return records


def ingest_log(spark: SparkSession, records: Iterable[IngestRecord]) -> DataFrame:
    rows = [tuple(asdict(r)[f] for f in INGEST_LOG_SCHEMA.names) for r in records]
    return spark.createDataFrame(rows, INGEST_LOG_SCHEMA)
