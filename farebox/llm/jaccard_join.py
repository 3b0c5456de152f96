"""N-gram Jaccard join: documents whose shingle sets overlap enough, as connected classes.

Equal sets form a class first. The search over classes is a T-occurrence search: a pair that reaches the
similarity shares at least T shingles, hence several of the rarest of each side. Posting lists of those
rare shingles give candidate pairs and, joined up, blocks of classes that may be similar. Every class is
sent to its block once. There, DivideSkip finds the links: the short inverted lists of a query are merged,
the longest are set aside, and candidates with enough occurrences are probed for the shingles of the long
ones by binary search. Classes that are already connected are not compared again, so a group of copies
costs about as many comparisons as it has members. Blocks of bounded size are searched in one task; larger
ones are cut. Across a cut, candidates of short lists are compared pair by pair; for what long lists leave
open, each class is sent once to a search of every two parts, which looks for links between them only.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from farebox.llm.components import components
from farebox.llm.shingles import WORDS, shingle_sets
from farebox.llm.tables import flagged, input_parts, map_batches, slots, stage
from farebox.llm.tokens import portions

# Similarity as a fraction: 100 * shared >= 80 * union.
NUMERATOR, DENOMINATOR = 4, 5
# Buckets of the frequency sketch that orders shingles: so many for so many scan tasks, growing with them.
SKETCH_BITS, SKETCH_TASKS, MOST_BITS = 18, 32, 22
# Longer posting lists are not paired up but join their members in a block.
LONG_LIST = 64
# A candidate pair shares this part of its smaller set among the rare shingles.
RARE_SHARE = 16
# Shingles that one task compares at a time.
BLOCK_SHINGLES = 4_000_000
# Candidates of a set that are tried one by one before the others are counted together.
ONE_BY_ONE = 32
_FLUSH = 250_000
_POSTING = np.dtype([("key", "<u8"), ("cls", "<i8"), ("n", "<u4")])


def least_overlap(total: np.ndarray | int):
    """Shared shingles that two sets of ``total`` shingles together need."""
    return -(-NUMERATOR * total // (NUMERATOR + DENOMINATOR))


def least_rare(n):
    """Rare shingles that a partner of a set of ``n`` shares at least; the set has as many more of them."""
    return np.maximum(1, n // RARE_SHARE)


def _signature(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _sets(texts: list[str], size: int) -> list[np.ndarray]:
    hashes, ends = shingle_sets(texts, size)
    return np.split(hashes, ends[:-1])


def sketch_bits(tasks: int) -> int:
    return min(MOST_BITS, SKETCH_BITS + max(0, -(-tasks // SKETCH_TASKS) - 1).bit_length())


def _describe(size: int, bits: int):
    """Per document its class; per task a sketch of how often shingles occur, in numbered slices."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << bits, np.uint32)
        schema = pa.schema(
            [("doc_id", pa.int64()), ("place", pa.int64()), ("n", pa.int32()), ("cls", pa.int64()), ("sketch", pa.binary())]
        )
        for batch in batches:
            for first, part in portions(batch.column(2).to_pylist()):
                sets = _sets(part, size)
                every = np.concatenate(sets)
                bucket, count = np.unique((every >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
                sketch[bucket] += count.astype(np.uint32)
                n, cls = [len(s) for s in sets], [_signature(s) if len(s) else None for s in sets]
                keys = [batch.column(k).slice(first, len(part)) for k in range(2)]
                columns = [*keys, pa.array(n, pa.int32()), pa.array(cls, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(part), pa.binary())], schema=schema)
        if sketch.any():
            for no, part in enumerate(np.split(sketch.astype("<u4"), len(sketch) >> SKETCH_BITS)):
                none = pa.nulls(1, pa.int64())
                row = [none, none, pa.array([no], pa.int32()), none, pa.array([part.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, schema=schema)

    return run


def _add_sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for no, body in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = np.frombuffer(body.as_py(), "<u4").astype(np.int64)
            total[no] = counts + total.get(no, 0)
    for no, counts in total.items():
        kept = np.minimum(counts, (1 << 32) - 1).astype("<u4")
        yield pa.RecordBatch.from_arrays([pa.array([no], pa.int32()), pa.array([kept.tobytes()], pa.binary())], names=["n", "sketch"])


def _frequencies(sketches: DataFrame) -> np.ndarray:
    """How often the shingles of a bucket occur where that stands out, else 0.

    The sketches are added in two steps, each a stream of slices of fixed size.
    """
    schema = "n int, sketch binary"
    step = map_batches(sketches.repartition(math.isqrt(slots(sketches)) + 1), _add_sketches, schema)
    rows = sorted(map_batches(step.coalesce(1), _add_sketches, schema).collect())
    if not rows:
        return np.zeros(1 << SKETCH_BITS, np.uint32)
    counts = np.concatenate([np.frombuffer(row.sketch, "<u4") for row in rows])
    return np.where(counts > 2 * counts.mean() + 8, counts, 0).astype(np.uint32)


def _rarest(shingles: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """The rarest shingles of a set; of these, every partner shares ``least_rare`` or more.

    A partner lacks at most a fifth of the set, so it has that many of any fifth and so many more.
    """
    n = len(shingles)
    rank = frequency[(shingles >> np.uint64(65 - len(frequency).bit_length())).astype(np.int64)]
    order = np.lexsort((shingles, rank))
    return shingles[order[: n - -(-NUMERATOR * n // DENOMINATOR) + int(least_rare(n))]]


def _post(size: int, frequency: np.ndarray, buckets: int):
    """Postings of the rare shingles, packed by bucket; a class once per task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        count = 0

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(held)
            bucket = (rows["key"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rows, bucket = rows[order], bucket[order]
            used, first = np.unique(bucket, return_index=True)
            parts = [part.tobytes() for part in np.split(rows, first[1:])]
            columns = [pa.array(used, pa.int32()), pa.array(parts, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "postings"])

        for batch in batches:
            for _, part in portions(batch.column(0).to_pylist()):
                for shingles in _sets(part, size):
                    cls = _signature(shingles)
                    if not len(shingles) or cls in seen:
                        continue
                    seen.add(cls)
                    rare = _rarest(shingles, frequency)
                    rows = np.empty(len(rare), _POSTING)
                    rows["key"], rows["cls"], rows["n"] = rare, cls, len(shingles)
                    held.append(rows)
                    count += len(rows)
                if count >= _FLUSH:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()

    return run


def _pairs_of(rows: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """((a, b, least shared) of pairs within lists whose sizes do not rule them out, lists of each pair)."""
    out = [np.zeros((0, 3), np.int64)]
    for size in np.unique(length):
        left, right = np.triu_indices(size, 1)
        lists = rows[first[length == size][:, None] + np.arange(size)]
        a, b = lists[:, left].ravel(), lists[:, right].ravel()
        low, high = np.minimum(a["n"], b["n"]).astype(np.int64), np.maximum(a["n"], b["n"]).astype(np.int64)
        possible = DENOMINATOR * low >= NUMERATOR * high
        out.append(np.stack([a["cls"], b["cls"], least_rare(low)], axis=1)[possible])
    pairs = np.concatenate(out)
    order = np.lexsort(pairs.T)
    pairs = pairs[order]
    begin = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)])[: len(pairs)])
    return pairs[begin], np.diff(np.append(begin, len(pairs)))


def _match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From all postings of a bucket: candidate pairs of short lists, members of long ones."""
    held = [np.frombuffer(body, _POSTING) for batch in batches for body in batch.column(1).to_pylist()]
    if not held:
        return
    rows = np.concatenate(held)
    rows = rows[np.lexsort((rows["cls"], rows["key"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["key"][1:] != rows["key"][:-1]) | (rows["cls"][1:] != rows["cls"][:-1])
    rows = rows[new]
    first = np.flatnonzero(np.concatenate([[True], rows["key"][1:] != rows["key"][:-1]]))
    length = np.diff(np.append(first, len(rows)))
    short = (length > 1) & (length <= LONG_LIST)
    pairs, seen = _pairs_of(rows, first[short], length[short])
    names = ["key", "a", "b", "least", "seen"]
    if len(pairs):
        columns = [pa.nulls(len(pairs), pa.int64()), *map(pa.array, pairs.T.copy()), pa.array(seen)]
        yield pa.RecordBatch.from_arrays(columns, names=names)
    long = np.repeat(length > LONG_LIST, length)
    if long.any():
        none = pa.nulls(long.sum(), pa.int64())
        columns = [pa.array(rows["key"][long].view(np.int64)), pa.array(rows["cls"][long]), none, none, none]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def link_sets(sets: list[np.ndarray], side: np.ndarray | None = None, known: np.ndarray | None = None) -> np.ndarray:
    """A label per set: the index of the first set that it is connected to by links.

    With ``side`` only sets of different sides are compared; sets with equal ``known`` are connected already.
    """
    n = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(n, kind="stable")
    ranked = [sets[i] for i in order]
    n = n[order]
    ends = np.cumsum(n)
    owner = np.repeat(np.arange(len(sets)), n)
    tokens, token = np.unique(np.concatenate([*ranked, np.zeros(0, np.uint64)]), return_inverse=True)
    # Inverted lists in order of set size; ``place`` is where an entry is in them.
    by_list = np.argsort(token, kind="stable")
    entries = owner[by_list]
    place = np.empty(len(token), np.int64)
    place[by_list] = np.arange(len(token))
    start = np.searchsorted(token[by_list], np.arange(len(tokens)))
    label = np.arange(len(sets))
    if known is not None:
        _, first, which = np.unique(known[order], return_index=True, return_inverse=True)
        label = first[which]
    side = None if side is None else side[order]
    for q in range(len(sets)):
        own = slice(ends[q] - n[q], ends[q])
        begin, stop = start[token[own]], place[own]
        smallest = np.searchsorted(n, -(-NUMERATOR * n[q] // DENOMINATOR))
        length = stop - begin
        if smallest >= q or not length.any():
            continue
        need = -(-NUMERATOR * n[q] // DENOMINATOR)
        # The longest lists set aside: more of them, the longer they are.
        aside = min(int(need) - 1, int(need / (0.1 * math.log2(length.max() + 1) + 1)))
        by_length = np.argsort(length, kind="stable")
        near, far = by_length[: len(by_length) - aside], by_length[len(by_length) - aside :]
        size = length[near]
        spot = np.repeat(begin[near] - np.cumsum(size) + size, size) + np.arange(size.sum())
        seen = np.bincount(entries[spot], minlength=q)[:q]
        seen[:smallest] = 0
        found = np.flatnonzero(seen >= max(1, need - aside))
        if side is not None:
            found = found[side[found] != side[q]]
        found = found[label[found] != label[q]]
        found = found[np.argsort(-seen[found], kind="stable")]
        probes = ranked[q][far]
        for c in found[:ONE_BY_ONE]:
            if label[c] == label[q]:
                continue
            at = np.minimum(np.searchsorted(ranked[c], probes), n[c] - 1)
            shared = seen[c] + np.count_nonzero(ranked[c][at] == probes)
            if shared >= least_overlap(n[q] + n[c]):
                low, high = sorted((label[c], label[q]))
                label[label == high] = low
        found = found[ONE_BY_ONE:]
        found = found[label[found] != label[q]]
        if len(found):
            size = length[far]
            spot = np.repeat(begin[far] - np.cumsum(size) + size, size) + np.arange(size.sum())
            shared = seen + np.bincount(entries[spot], minlength=q)[:q]
            linked = label[found[shared[found] >= least_overlap(n[q] + n[found])]]
            if len(linked):
                joined = np.unique(np.append(linked, label[q]))
                label[np.isin(label, joined)] = joined[0]
    out = np.empty(len(sets), np.int64)
    # Name each component after its first set in the order given.
    least = np.full(len(sets), len(sets))
    np.minimum.at(least, label, order)
    out[order] = least[label]
    return out


def _search(size: int):
    """Links within blocks; the rows of a block come one after the other."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, classes, texts = None, [], []

        def close() -> pa.RecordBatch:
            sets = {}
            for first, part in portions(texts):
                for cls, shingles in zip(classes[first:], _sets(part, size)):
                    # A text with the hash of another may be of another class; copies count once.
                    if cls == _signature(shingles):
                        sets[cls] = shingles
            names = np.array(list(sets), np.int64)
            label = names[link_sets(list(sets.values()))] if sets else names
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(label)], names=["cls", "label"])

        for batch in batches:
            for now, cls, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if now != block and classes:
                    yield close()
                    classes, texts = [], []
                block = now
                classes.append(cls)
                texts.append(text)
        if classes:
            yield close()

    return run


def _meet(size: int):
    """Links between the two parts of each meeting; its rows come one after the other."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meeting, held = None, []

        def close() -> pa.RecordBatch:
            cls, part, known, texts = zip(*held)
            sets = [shingles for _, some in portions(list(texts)) for shingles in _sets(some, size)]
            names = np.array(cls, np.int64)
            label = names[link_sets(sets, np.array(part), np.array(known))]
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(label)], names=["cls", "label"])

        for batch in batches:
            for now, *row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if now != meeting and held:
                    yield close()
                    held = []
                meeting = now
                held.append(row)
        if held:
            yield close()

    return run


def _compare(size: int):
    """The pairs (a, b, text of a, text of b) that are similar enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in portions(batch.column(2).to_pylist()):
                left = _sets(part, size)
                right = _sets(batch.column(3).slice(first, len(part)).to_pylist(), size)
                shared = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right)]
                linked = [s >= least_overlap(len(x) + len(y)) for s, x, y in zip(shared, left, right)]
                kept = batch.slice(first, len(part)).filter(pa.array(linked, pa.bool_()))
                yield kept.select(["a", "b"])

    return run


def _enough(found: DataFrame, listed: DataFrame) -> DataFrame:
    """Candidate pairs: what they share in short lists, and may share in long ones, reaches the least."""
    counted = found.groupBy("a", "b").agg(F.sum("seen").alias("seen"), F.first("least").alias("least"))
    more = {end: listed.select(F.col("cls").alias(end), F.col("lists").alias(f"more_{end}")) for end in "ab"}
    known = counted.join(more["a"], "a", "left").join(more["b"], "b", "left").na.fill(0, ["more_a", "more_b"])
    return known.where("seen >= least - least(more_a, more_b)").select("a", "b")


def _blocks(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, place, block, whole, component, cut, cuts): blocks of joined classes, cut by family where they are
    too large; two parts together are about as large as a whole one may be."""
    joined = components(edges, "a", "b").withColumnsRenamed({"node": "cls"})
    both = edges.select(F.col("a").alias("cls"), F.col("b").alias("near")).union(edges.select("b", "a"))
    family = both.groupBy("cls").agg(F.min("near").alias("near"))
    placed = joined.join(family, "cls").join(classes, "cls")
    placed = placed.withColumn("family", F.least("cls", "near"))
    total = placed.groupBy("component").agg(F.sum("n").alias("total"))
    crowd = placed.groupBy("component", "family").agg(F.sum("n").alias("crowd"))
    cuts = F.when(F.col("total") <= BLOCK_SHINGLES, 1).otherwise(F.ceil(2 * F.col("total") / BLOCK_SHINGLES))
    salts = F.ceil(2 * F.col("crowd") / BLOCK_SHINGLES)
    cut = F.when(cuts == 1, 0).otherwise(F.pmod(F.xxhash64("family", F.pmod(F.xxhash64("cls"), salts)), cuts))
    sized = placed.join(total, "component").join(crowd, ["component", "family"])
    block = F.xxhash64("component", cut)
    where = [block.alias("block"), (cuts == 1).alias("whole"), "component", cut.alias("cut"), cuts.alias("cuts")]
    return sized.select("cls", "place", *where)


def _once(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose place this task has not seen: copies of a text need not all be sent."""
    seen: set[int] = set()
    for batch in batches:
        fresh = []
        for place in batch.column(0).to_pylist():
            fresh.append(place not in seen)
            seen.add(place)
        yield batch.filter(pa.array(fresh, pa.bool_()))


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, place (a hash of the text) and text."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("place"), F.col(text).alias("text"))


def similar_classes(
    docs: DataFrame, size: int = WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles and component_id.

    Links join documents of which 4/5 of all their distinct shingles are shared; ``component_id`` is the
    least id reachable over links, the own one included. A document with fewer words than a shingle has
    the sequence of all its words as its only shingle. A null text and one without words has no shingle and no
    link. Rows with one id and different texts are documents of their own, and rows without an id take part like
    others: links run through them, but they never name a component unless nothing else is in it. An empty
    table gives an empty result. Texts, sets and classes are compared by 64-bit hashes.
    """
    found = _components(_rows(docs, doc_id, text), slots(docs), input_parts(docs), size)
    named = found.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return named.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def _key(doc_id: Column, place: Column) -> Column:
    """A hash of a row's id and text."""
    return F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), place)


def one_of_each(docs: DataFrame, size: int = WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that with the least id, then text hash; all columns are kept.

    Of rows with the same id and text one stays, the least by a hash of the whole row. Rows without a word are
    linked with nothing and all stay. Only rows of components of several rows, and few others, are shuffled.
    """
    described = _components(_rows(docs, doc_id, text), slots(docs), input_parts(docs), size)
    members = described.where("component IS NOT NULL").withColumn("key", _key(F.col("doc_id"), F.col("place")))
    # Without an id last; struct() orders by its fields.
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place", "key")
    groups = members.groupBy("component").agg(F.count("*").alias("rows"), F.min(rank)["key"].alias("first"))
    groups = groups.where("rows > 1")
    decided = members.join(groups, "component").select("key", (F.col("key") == F.col("first")).alias("stays"))
    decided = stage(decided.distinct(), "decided")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), _key(F.col(doc_id).cast("long"), F.xxhash64(text)).alias("key"))
    marked = flagged(keyed, decided, "key")
    alone = marked.where("NOT maybe").select("row.*")
    met = marked.where("maybe").join(decided.hint("merge"), "key", "left").where("stays IS NULL OR stays")
    same = Window.partitionBy("key").orderBy(F.xxhash64("row"))
    # Rows that the filter let through by chance are in no group: each of them stays.
    first = met.where("stays").withColumn("rank", F.row_number().over(same)).where("rank = 1").select("row.*")
    return alone.union(first).union(met.where("stays IS NULL").select("row.*"))


def _components(rows: DataFrame, parts: int, tasks: int, size: int) -> DataFrame:
    """doc_id, place, n, component (null without a shingle) and component_id (null without an id) of every row."""
    describe = _describe(size, sketch_bits(tasks))
    schema = "doc_id long, place long, n int, cls long, sketch binary"
    described = stage(map_batches(rows, describe, schema), "described")
    frequency = _frequencies(described.where("sketch IS NOT NULL").select("n", "sketch"))
    members = described.where("sketch IS NULL").drop("sketch")
    # Of each class one text, wherever it stands, is enough to compare it.
    of_class = [F.min("doc_id").alias("doc_id"), F.min("place").alias("place"), F.first("n").alias("n")]
    classes = members.where("n > 0").groupBy("cls").agg(*of_class)
    posted = map_batches(rows.select("text"), _post(size, frequency, parts), "bucket int, postings binary")
    schema = "key long, a long, b long, least long, seen long"
    found = stage(map_batches(posted.repartition(parts, "bucket"), _match, schema), "candidates")
    lists = found.where("key IS NOT NULL").select("key", F.col("a").alias("cls"))
    listed = lists.groupBy("cls").agg(F.count("*").alias("lists")).join(classes, "cls").select("cls", "n", "lists")
    listed = stage(listed, "listed")
    pairs = stage(_enough(found.where("key IS NULL"), listed), "pairs")
    # Only classes with so many long lists can have a partner that shares nothing but those.
    alone = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * NUMERATOR / DENOMINATOR) / RARE_SHARE))
    lists = lists.join(listed.where(F.col("lists") >= alone).select("cls"), "cls")
    hubs = lists.groupBy("key").agg(F.min("cls").alias("hub"))
    spokes = lists.join(hubs, "key").where("cls <> hub").select(F.col("hub").alias("a"), F.col("cls").alias("b"))
    blocks = stage(_blocks(stage(pairs.union(spokes.distinct()), "edges"), classes), "blocks")
    # The blocks grow with the documents, so the text side never relies on a broadcast of them.
    wanted = flagged(rows.select("place", "text"), blocks, "place").where("maybe").drop("maybe")
    wanted = map_batches(wanted, _once, "place long, text string")
    found = wanted.join(blocks.hint("merge"), "place").select("block", "cls", "text", "whole")
    sent = found.drop("whole").repartition(parts, "block").sortWithinPartitions("block")
    labels = stage(map_batches(sent, _search(size), "cls long, label long"), "labels")
    # A block that is whole has its final labels; parts of a cut one are joined up once more.
    joined = labels.withColumnsRenamed({"label": "component"})
    if not blocks.where("NOT whole").isEmpty():
        parted = found.where("NOT whole").drop("whole")
        bodies = stage(map_batches(parted, _only_class(size), "cls long, text string").dropDuplicates(["cls"]), "bodies")
        across = _across(blocks.where("NOT whole"), labels, pairs, lists, bodies, size)
        joined = components(labels.union(across), "cls", "label").withColumnsRenamed({"node": "cls"})
    named = classes.join(joined, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = stage(named.join(least, "component").select("cls", "component", "component_id"), "components")
    return members.join(of_class, "cls", "left").select("doc_id", "place", "n", "component", "component_id")


def _only_class(size: int):
    """Of (block, cls, text), the rows whose text is of that class."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in portions(batch.column(2).to_pylist()):
                own = pa.array([_signature(s) for s in _sets(part, size)], pa.int64())
                rows = batch.slice(first, len(part)).select(["cls", "text"])
                yield rows.filter(pa.compute.equal(rows.column(0), own))

    return run


def _across(
    cut: DataFrame, labels: DataFrame, pairs: DataFrame, lists: DataFrame, bodies: DataFrame, size: int
) -> DataFrame:
    """Links between the parts of blocks that were cut, as (cls, label) rows.

    Candidates that are in one part have been compared, connected ones need not be. Long lists are first
    tried along a chain of one member per label. Members of lists that this leaves open are sent once to every
    meeting of their part with another part of the block.
    """
    at = cut.join(labels, "cls").select("cls", "block", "label", "component", "cut", "cuts")

    def differing(candidates: DataFrame, now: DataFrame) -> DataFrame:
        left = now.select(F.col("cls").alias("a"), F.col("block").alias("ba"), F.col("label").alias("la"))
        right = now.select(F.col("cls").alias("b"), F.col("block").alias("bb"), F.col("label").alias("lb"))
        return candidates.join(left, "a").join(right, "b").where("ba <> bb AND la <> lb").select("a", "b").distinct()

    def linked(candidates: DataFrame) -> DataFrame:
        left = bodies.select(F.col("cls").alias("a"), F.col("text").alias("x"))
        right = bodies.select(F.col("cls").alias("b"), F.col("text").alias("y"))
        texts = candidates.join(left, "a").join(right, "b").select("a", "b", "x", "y")
        return stage(map_batches(texts, _compare(size), "a long, b long"), "links")

    heads = lists.join(at, "cls").groupBy("key", "label").agg(F.min("cls").alias("cls"))
    chain = heads.select(
        F.col("cls").alias("a"), F.expr("lead(cls) OVER (PARTITION BY key ORDER BY cls)").alias("b")
    ).where("b IS NOT NULL")
    first = linked(differing(pairs.union(chain), at))
    joined = components(labels.union(first), "cls", "label").withColumnsRenamed({"node": "cls"})
    joined = joined.withColumnRenamed("component", "joined")
    now = at.join(joined, "cls", "left").withColumn("label", F.coalesce("joined", "label")).drop("joined", "block")
    now = stage(now, "now")
    mixed = lists.join(now, "cls").groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h")
    open_ = now.join(lists.join(mixed.select("key"), "key").select("cls").distinct(), "cls")
    met = open_.join(bodies, "cls").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
    meeting = F.xxhash64("component", F.least("cut", "other"), F.greatest("cut", "other")).alias("meeting")
    sent = met.where("other <> cut").select(meeting, "cls", "cut", "label", "text")
    sent = sent.repartition(slots(bodies), "meeting").sortWithinPartitions("meeting")
    found = map_batches(sent, _meet(size), "cls long, label long").where("cls <> label")
    return first.union(stage(found, "meetings"))
