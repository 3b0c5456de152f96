"""Scans and file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from farebox.sources.descriptor import DatasetSpec


def read_raw(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """The file as it is: text for CSV, file types for Parquet. No inference pass."""
    return spark.read.format(spec.format).options(**spec.options).load(spec.path)


def read_csv_text(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """CSV with a header, every column as text, only the header line is read up front."""
    reader = spark.read.option("header", "true")
    if names is not None:
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType(), True) for n in names]))
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", "true").csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def evaluate(df: DataFrame) -> None:
    """Run the whole plan and discard the rows."""
    df.write.format("noop").mode("overwrite").save()
