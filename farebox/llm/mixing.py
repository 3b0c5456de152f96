"""Mixing sources to target weights: how many copies of each document a mix takes.

Every source has a weight and a target of words; a target above what the source may give is cut and the
excess shared again by weight. The target over the size of a source is the expected number of copies of
each of its documents. Its whole part is taken as it is; the fraction is rounded by the pivotal method:
two documents at a time, words are transferred between them at random until one is in or out, so that
every document keeps its probability and a source keeps its number of words. Each bucket of documents
leaves one undecided document per source. Buckets are nodes of a reduction tree: the undecided of
``FAN`` nodes meet in the next one, until the root rounds one document per source by chance. The words
taken of a source therefore differ from its target by less than one document.

Buckets, order and chance come from hashes of the rows and the number of rows alone. Runs agree whatever
the cluster, and lost tasks come to the same again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from farebox.llm.tables import map_batches, slots, stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BUCKET_ROWS = 16_384
FAN = 32
_WORDS = r"[^\x20\x09-\x0D]+"
_MASK = (1 << 64) - 1
_NAMES = ["doc_id", "source", "size", "source_size", "target", "place", "base", "fraction", "node", "copies"]


def _place(doc_id: str, text: str, source: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(doc_id).cast("string"), F.col(source).cast("string"), F.col(text))


def sized(docs: DataFrame, doc_id: str, text: str, source: str, seed: int) -> DataFrame:
    """What the mix needs of a document: id, source, words and a hash of the row."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(_WORDS)), F.lit(0)).cast("long")
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        size.alias("size"),
        _place(doc_id, text, source, seed).alias("place"),
    )


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target, n_docs), one row per source of ``sizes`` (source, size).

    Sources by code point, NULL last, have ``weights`` in turn and share ``share`` of all words; no
    target is above ``most`` times the size of its source. The sources that reach that bound are those
    whose bound is least for their weight; what remains is shared by the others. Only one row per source
    passes through the windows.
    """
    everything = Window.partitionBy()
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    bound = (F.lit(float(most)) * F.col("source_size")).alias("bound")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    known = totals.withColumn("weight", weight).withColumn("bound", bound)
    order = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)

    def left(of: str):
        """Sum over this source and those after it."""
        return F.sum(of).over(everything) - F.coalesce(F.sum(of).over(earlier), F.lit(0.0))

    pool = F.least(F.lit(float(share)) * F.sum("source_size").over(everything), F.sum("bound").over(everything))
    open_pool = pool - F.coalesce(F.sum("bound").over(earlier), F.lit(0.0))
    tested = known.withColumn("pool", pool).withColumn("full", open_pool * F.col("weight") >= F.col("bound") * left("weight"))
    rest = F.col("pool") - F.sum(F.when(F.col("full"), F.col("bound")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("bound")).otherwise(F.try_divide(rest * F.col("weight"), open_weight))
    return tested.withColumn("target", target).select("source", "source_size", "target", "n_docs")


# -- pivotal rounding ----------------------------------------------------------


def chance(a: int, b: int) -> float:
    """A number in [0, 1) that two hashes decide."""
    x = (a * 0x9E3779B97F4A7C15 + b * 0xD1B54A32D192ED03 + 0x2545F4914F6CDD1D) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return ((x ^ (x >> 31)) >> 11) / (1 << 53)


def transfer(size_a: int, a: float, size_b: int, b: float, luck: float) -> tuple[float, float]:
    """New fractions of two documents, one of them 0 or 1; the words they stand for stay the same.

    A fraction rises as often and as far as it falls.
    """
    up = min(size_a * (1 - a), size_b * b)
    down = min(size_a * a, size_b * (1 - b))
    if luck * (up + down) < down:
        if size_a * (1 - a) <= size_b * b:
            return 1.0, max(0.0, b - size_a * (1 - a) / size_b)
        return min(1.0, a + size_b * b / size_a), 0.0
    if size_a * a <= size_b * (1 - b):
        return 0.0, min(1.0, b + size_a * a / size_b)
    return max(0.0, a - size_b * (1 - b) / size_a), 1.0


# A fraction so close to 0 or 1 is one: what adding up doubles leaves.
_EPSILON = 1e-9


def _settled(fraction: float) -> int | None:
    return 0 if fraction < _EPSILON else 1 if fraction > 1 - _EPSILON else None


def _rounding(schema: pa.Schema, last: bool):
    def decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        out: list[dict] = []

        def close(row: dict) -> None:
            whole = _settled(row["fraction"])
            if whole is None and last:
                whole = int(chance(row["place"], 0) < row["fraction"])
            row["copies"] = None if whole is None else row["base"] + whole
            out.append(row)

        for batch in batches:
            for row in batch.to_pylist():
                if held is not None and (held["node"], held["source"]) != (row["node"], row["source"]):
                    close(held)
                    held = None
                if held is None:
                    held = row
                    continue
                luck = chance(held["place"], row["place"])
                pair = transfer(held["size"], held["fraction"], row["size"], row["fraction"], luck)
                held["fraction"], row["fraction"] = pair
                if _settled(held["fraction"]) is None:
                    held, row = row, held
                close(held)
                held = row
                if _settled(held["fraction"]) is not None:
                    close(held)
                    held = None
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if held is not None:
            close(held)
            yield pa.RecordBatch.from_pylist(out, schema)

    return decide


_SCHEMA = (
    "doc_id long, source string, size long, source_size long, target double, place long, base long, fraction double,"
    " node long, copies long"
)
_ARROW = pa.schema(
    [
        (name, pa.string() if name == "source" else pa.float64() if name in ("target", "fraction") else pa.int64())
        for name in _NAMES
    ]
)


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 0,
    bucket_rows: int = BUCKET_ROWS,
    fan: int = FAN,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size (words), source_size, target, place (a hash of
    the row) and copies, how often the mix takes the document.

    A document without words (null or empty text) takes no part in the rounding and gets the whole part
    of its expected copies. A null source is a source of its own. Repeated rows are rounded each for
    itself. Other columns are left out, and an empty table gives an empty result.
    """
    sizes = stage(sized(docs, doc_id, text, source, seed), "mix-sizes")
    targets = stage(source_targets(sizes, weights, share, most), "mix-targets")
    # Buckets follow from the number of rows, so that they do not depend on the cluster.
    n_rows = targets.agg(F.sum("n_docs")).first()[0] or 0
    nodes = 1
    while nodes * bucket_rows < n_rows:
        nodes *= 2
    parts = slots(sizes)
    expected = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    known = sizes.join(targets.drop("n_docs").withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    known = known.withColumn("expected", expected).withColumn("base", F.floor(F.col("expected") + F.lit(_EPSILON)))
    fraction = F.greatest(F.col("expected") - F.col("base"), F.lit(0.0))
    open_ = (F.col("fraction") >= _EPSILON) & (F.col("size") > 0)
    rows = known.withColumn("fraction", fraction).select(
        *_NAMES[:8],
        F.pmod(F.xxhash64("place"), F.lit(nodes)).alias("node"),
        F.when(~open_, F.col("base")).alias("copies"),
    )
    decided = [rows.where("copies IS NOT NULL")]
    left = rows.where("copies IS NULL")
    while True:
        last = nodes == 1
        ordered = left.repartition(min(parts, nodes), "node").sortWithinPartitions("node", "source", "place", "doc_id", "size")
        rounded = stage(map_batches(ordered, _rounding(_ARROW, last), _SCHEMA), "mix-rounded")
        decided.append(rounded.where("copies IS NOT NULL"))
        if last:
            break
        nodes = -(-nodes // fan)
        left = rounded.where("copies IS NULL").withColumn("node", F.expr(f"node DIV {fan}"))
    mixed = decided[0]
    for part in decided[1:]:
        mixed = mixed.unionByName(part)
    return mixed.select(*_NAMES[:6], "copies")


def repeated(
    docs: DataFrame, mix: DataFrame, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The documents of a mix, each as often as ``mix`` (from the same ``docs`` and seed) takes it.

    Rows of one id, source and text are one document held several times: all its copies come out under
    the other columns of one of them. The texts are shuffled once, by their hash.
    """
    taken = mix.groupBy("place").agg(F.sum("copies").alias("n")).where("n > 0")
    place = _place(doc_id, text, source, seed)
    rows = docs.select(F.struct(*docs.columns).alias("row"), place.alias("place"))
    alike = Window.partitionBy("place").orderBy(F.xxhash64("row"))
    one = rows.withColumn("rank", F.row_number().over(alike)).where("rank = 1")
    return one.join(taken, "place").select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")
