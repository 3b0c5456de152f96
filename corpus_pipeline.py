"""From raw documents to packed sequences: the stages in order, each on all that its predecessor kept.

Every stage but the last returns the columns of its input. Rows with null or empty texts, repeated rows
and additional columns are allowed everywhere; what a stage does with them is said where it is defined.
SQL cannot tokenise, so there is no SQL for the result; tests compare every stage and the result with a plain version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from farebox.llm import decontaminate, jaccard_join, language_id, packing, queries, secret_scan
from farebox.llm.tables import read_table, stage

ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is identified; those without a letter go."""
    return language_id.keep_identified(docs, queries.learned_languages(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, that with the least id; rows without a word all stay."""
    return jaccard_join.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no passage of the benchmark."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, with a mark in place of each secret; ``n_chars`` follows the text."""
    # The row is packed away, so that its columns may have any name.
    packed = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = secret_scan.find_spans(packed, into="found")
    told = found.select("row", "found", secret_scan.redacted(F.col("text"), F.col("found")).alias("told"))
    columns = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("told")}
    if "n_chars" in columns:
        length = F.length("told").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.size("found") > 0, length).otherwise(columns["n_chars"])
    return told.select(*[column.alias(c) for c, column in columns.items()])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language identification", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("secret scan", redact_secrets),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), "pipeline")
    return docs
