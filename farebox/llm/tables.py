"""Reading the text tables and keeping intermediate results."""

from __future__ import annotations

import contextlib
import tempfile
import zipfile
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

import farebox
from farebox.sources.scratch import stage

__all__ = ["flagged", "input_parts", "map_batches", "read_table", "slots", "stage", "text_or_empty"]

_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Let Spark hand this package to the Python tasks, whether or not it is installed there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(farebox.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="farebox-")) / "farebox.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def _give_back() -> None:
    """Return what freed arrays still hold: the worker goes on to other tasks, next to the executor's own heap."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks."""
    _ship(df.sparkSession)

    def run(batches):
        yield from function(batches)
        _give_back()

    return df.mapInArrow(run, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Iterable[str]) -> DataFrame:
    """The named columns of one table of the corpus."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def input_parts(df: DataFrame) -> int:
    """Tasks that scan ``df``; it follows the size of the input."""
    return df.rdd.getNumPartitions()


def slots(df: DataFrame, least: int = 12) -> int:
    """Partitions for a keyed exchange of what ``df`` holds: in proportion to its scan tasks.

    One number for both sides of a join keeps them aligned. The floor is the session's setting, so
    that a small input on a large cluster is still spread.
    """
    session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, session, 2 * input_parts(df))


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


# Bits of the filter below: one megabyte, whatever the number of keys.
_FILTER_BITS = 23


def _slot(column: str) -> tuple[Column, Column]:
    """Word and bit of a key in the filter."""
    at = F.pmod(F.xxhash64(column), F.lit(1 << _FILTER_BITS))
    return F.shiftright(at, 6), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))


def flagged(rows: DataFrame, keys: DataFrame, column: str, into: str = "maybe") -> DataFrame:
    """``rows`` with a column ``into``: false only where ``column`` is certainly not among that of ``keys``.

    It keeps rows without a partner out of the shuffle of an exact join behind it. The broadcast side
    has at most 2 ** 17 rows of two numbers, however many keys there are; with very many keys it lets
    all rows pass and the join alone decides.
    """
    word, bit = _slot(column)
    bits = keys.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.expr("bit_or(__bit)").alias("__bits"))
    joined = rows.withColumn("__word", word).join(F.broadcast(bits), "__word", "left")
    hit = F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))
    return joined.withColumn(into, hit).drop("__word", "__bits")
