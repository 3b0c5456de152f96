"""The update loads fed by a folder that files arrive in.

The stream's checkpoint remembers which files were read, so it takes the place
of a pipeline-state file. Each micro-batch goes through the same load as a
batch update and is stored under a batch number derived from its epoch: when a
failed epoch is repeated, it replaces its own batch.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from farebox.plans.updates import UpdateRecord, load_update
from farebox.sources.descriptor import DatasetSpec
from farebox.sources.tables import Table


def update_stream(
    table: Table,
    spec: DatasetSpec,
    landing: str,
    checkpoint: str,
    raw_schema: T.StructType,
    new_types: Mapping[str, T.DataType] | None = None,
    event_time: str | None = None,
    records: list[UpdateRecord] | None = None,
) -> StreamingQuery:
    """Load all files of ``landing`` that were not loaded yet, then stop.

    After its initial load (batch 0) the table must be fed by this stream only,
    since epoch ``n`` owns batch ``n + 1``. ``records`` collects what each epoch did.
    """
    spark = table.spark

    def load(files: DataFrame, epoch: int) -> None:
        batch = epoch + 1
        newest = table.version()
        if newest is None or newest > batch:
            raise RuntimeError(f"{table.path} is at version {newest}, epoch {epoch} expected it below {batch + 1}")
        record = load_update(table, files, spec, new_types, event_time, batch)
        if records is not None:
            records.append(record)

    arriving = spark.readStream.format(spec.format).schema(raw_schema).options(**spec.options).load(landing)
    return (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
