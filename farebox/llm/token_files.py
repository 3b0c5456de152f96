"""Token id files: documents compressed one by one with a shared dictionary.

A dictionary is trained on serialised id arrays of a bounded sample of documents. The ids of every
document, little-endian unsigned 32-bit, are one zstandard frame of their own, so a short document is
read without its neighbours. Frames in ascending document order form segments; a segment holds the
frames end to end, the index of their ends and token counts, and the hash of the dictionary. Segments
are rows of Parquet files that Spark commits, next to the dictionary.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from farebox.llm.tables import map_batches, slots, stage
from farebox.llm.tokens import batch_rows, encoder, portions, spaced_words

# Bounds of the sample that trains the dictionary: documents, and ids of each.
SAMPLE_DOCS, SAMPLE_IDS = 1000, 8192
DICTIONARY_BYTES = 64 << 10
SEGMENT_BYTES, SEGMENT_DOCS = 4 << 20, 4096
_SEGMENT = (
    "part int, segment int, start long, n_tokens long, first_doc long, last_doc long, dictionary string, "
    "doc_ids array<long>, counts array<long>, ends array<long>, payload binary"
)
_FIELDS = pa.schema(
    [
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("first_doc", pa.int64()),
        ("last_doc", pa.int64()),
        ("dictionary", pa.string()),
        ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)


def _hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()


def train_dictionary(
    docs: DataFrame, tokenizer: str, cut: Callable = spaced_words, end_id: int = 0, size: int = DICTIONARY_BYTES
) -> bytes:
    """A dictionary from at most ``SAMPLE_DOCS`` documents, those with the least hashes of id and text.

    Copies count once. Of each, the first ``SAMPLE_IDS`` ids are used. Empty when the sample is too small to train on.
    """

    def serialise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, cut).encode, end_id.to_bytes(4, "little")
        for batch in batches:
            for _, part in portions(batch.column(0).to_pylist()):
                ids = [(x + end)[: 4 * SAMPLE_IDS] for x in encode(part)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    spread = F.xxhash64("doc_id", "text")
    # A prefix of the text yields the prefix of the ids that is used; a token has few characters.
    chosen = docs.select(spread.alias("spread"), F.substring("text", 1, 16 * SAMPLE_IDS).alias("text"))
    # Twice the share, so that the limit and not chance sets the size.
    few = chosen.where(F.pmod("spread", F.lit(1 << 32)) < int(min(1.0, 2 * share) * (1 << 32))).dropDuplicates(["spread"])
    start = few.orderBy(F.pmod("spread", F.lit(1 << 32)), "spread").limit(SAMPLE_DOCS).select("text").repartition(slots(docs))
    sample = [bytes(r.ids) for r in map_batches(start, serialise, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(size, sorted(sample)).as_bytes()
    except zstandard.ZstdError:
        return b""


def _writer(tokenizer: str, cut: Callable, end_id: int, dictionary: bytes):
    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, cut).encode, end_id.to_bytes(4, "little")
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compress = zstandard.ZstdCompressor(level=3, dict_data=shared).compress
        task = TaskContext.get()
        part, name = task.partitionId() if task else 0, _hash(dictionary)
        made, start = 0, 0
        docs: list[int | None] = []
        counts: list[int] = []
        ends: list[int] = []
        payload = bytearray()

        def close() -> pa.RecordBatch:
            nonlocal made, start
            total = sum(counts)
            known = next((doc_id for doc_id in docs if doc_id is not None), None)
            row = [part, made, start, total, known, docs[-1], name, docs[:], counts[:], ends[:], bytes(payload)]
            made, start = made + 1, start + total
            for held in (docs, counts, ends, payload):
                held.clear()
            arrays = [pa.array([v], f.type) for v, f in zip(row, _FIELDS)]
            return pa.RecordBatch.from_arrays(arrays, schema=_FIELDS)

        for ids_of, bodies in (rows for batch in batches for rows in batch_rows(batch)):
            for doc_id, ids in zip(ids_of, encode(bodies)):
                payload += compress(ids + end)
                docs.append(doc_id)
                counts.append(len(ids) // 4 + 1)
                ends.append(len(payload))
                if len(payload) >= SEGMENT_BYTES or len(docs) >= SEGMENT_DOCS:
                    yield close()
        if docs:
            yield close()

    return segments


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    cut: Callable[[str], list[str]] = spaced_words,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Write all documents in ascending id order below ``path``, a folder that all executors share.

    A null or empty text is the end id alone. Null ids come first; rows with the same id are all
    written, in an order that depends on their texts only. Other columns are left out. An empty table writes no segment.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spark = docs.sparkSession
    dictionary = train_dictionary(rows, tokenizer, cut, end_id)
    spark.createDataFrame([(_hash(dictionary), dictionary)], "dictionary string, bytes binary").write.parquet(
        f"{path}/dictionary"
    )
    keyed = rows.repartitionByRange(slots(docs), "doc_id", F.xxhash64("text"))
    ordered = keyed.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    map_batches(ordered, _writer(tokenizer, cut, end_id, dictionary), _SEGMENT).write.parquet(f"{path}/segments")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first().bytes)


def _reader(dictionary: bytes, with_ids: bool, wanted: frozenset | None = None):
    name = _hash(dictionary)

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        expand = zstandard.ZstdDecompressor(dict_data=shared).decompress
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary"] != name:
                    raise ValueError(f"segment written with dictionary {row['dictionary']}, not {name}")
                out, at, begin = [], row["start"], 0
                for doc_id, count, end in zip(row["doc_ids"], row["counts"], row["ends"]):
                    if wanted is None or doc_id in wanted:
                        ids = expand(row["payload"][begin:end])
                        if len(ids) != 4 * count:
                            raise ValueError(f"document {doc_id} has {len(ids) // 4} ids, its index says {count}")
                        out.append((doc_id, at, count, zlib.crc32(ids), ids if with_ids else None))
                    at, begin = at + count, end
                if out:
                    columns = [pa.array(c, t) for c, t in zip(zip(*out), _DOC_TYPES)]
                    yield pa.RecordBatch.from_arrays(columns[: 4 + with_ids], names=_DOC_NAMES[: 4 + with_ids])

    return documents


_DOC_NAMES = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
_DOC_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_DOC = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments whose ``start`` counts all ids before them: their parts are in order."""
    segments = spark.read.parquet(f"{path}/segments")
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row per written part; a window over these few rows adds them up.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    based = segments.join(bases, "part")
    return based.withColumn("start", F.col("start") + F.col("base")).drop("base")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32 and, if asked, ids."""
    schema = _DOC + (", ids binary" if with_ids else "")
    return map_batches(_segments(spark, path), _reader(read_dictionary(spark, path), with_ids), schema)


def read_some(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The documents with the given ids; only their segments are read and only their frames expanded."""
    ranges = F.lit(False)
    for doc_id in doc_ids:
        ranges |= F.lit(doc_id).between(F.col("first_doc"), F.col("last_doc"))
    reader = _reader(read_dictionary(spark, path), True, frozenset(doc_ids))
    return map_batches(_segments(spark, path).where(ranges), reader, _DOC + ", ids binary")
