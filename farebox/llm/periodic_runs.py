"""Periodic runs of words: stretches that repeat themselves at a fixed distance.

A run is a stretch of at least ``shortest`` words and twice its smallest period that no neighbouring
word extends. Periods are handled by octaves ``[P, 2P)``. For an octave a document is exploded into
tiles of ``8P`` words that overlap by half, so every stretch of twice a period lies whole in some tile.
A tile is solved alone: boundaries stand every ``P`` words, so each run has one at least a period
before its end, and the Z-functions of a boundary (how far the words behind it, and those before it,
agree with the words one shift on) give the run for every shift of the octave. They are looked up for
all boundaries and shifts at once; most shifts fall to one comparison of a hashed block of words.
The pieces of runs that tiles find are then shuffled by document and period and stitched where they
overlap by a period.

Octaves whose tiles are no longer than the smallest tile share it, and those whose tiles hold the whole
document share one tile. A document of one tile, which most are, needs no shuffle at all.

Words are compared through two 31-bit polynomial hashes together with a mixed 64-bit hash of up to eight
words; two different stretches pass for equal only if all of these collide.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from farebox.llm.shingles import mixed
from farebox.llm.tables import map_batches, slots, stage

SHORTEST = 12
TILE = 8192
"""Words of the smallest tile; periods below a quarter of it need no larger one."""
_BYTES_PER_WORD = 4
_PORTION = 1 << 20
_SLICE = 1 << 17
_FIELDS = ((2147483647, 48271), (2147483629, 69621))
_MIX = np.uint64(0x9E3779B97F4A7C17)

_RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


# -- words ---------------------------------------------------------------------


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, ends): those of text i are ``words[ends[i - 1]:ends[i]]``; null texts have none."""
    listed = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat = listed.flatten()
    there = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    # ``flatten`` starts at the first offset of a sliced array.
    offsets = np.asarray(listed.offsets).astype(np.int64)
    return flat.filter(there), before[offsets[1:] - offsets[0]]


# -- equal stretches -----------------------------------------------------------


class _Stretches:
    """Compares stretches of a sequence of numbers."""

    def __init__(self, numbers: np.ndarray):
        self.size = len(numbers)
        self._single = mixed(numbers.astype(np.uint64) + np.uint64(1))
        self._fields = []
        for prime, base in _FIELDS:
            p = np.uint64(prime)
            power = np.ones(self.size + 1, np.uint64)
            done = 1
            while done <= self.size:
                more = min(done, self.size + 1 - done)
                power[done : done + more] = power[:more] * np.uint64(pow(base, done, prime)) % p
                done += more
            prefix = np.zeros(self.size + 1, np.uint64)
            np.cumsum(self._single % p * power[:-1] % p, out=prefix[1:])
            self._fields.append((p, power.astype(np.uint32), (prefix % p).astype(np.uint32)))

    def blocks(self, width: int) -> np.ndarray:
        """A hash of every stretch of ``width`` (a power of two) numbers."""
        out, have = self._single, 1
        while have < width:
            out, have = mixed(out[:-have] * _MIX + out[have:]), 2 * have
        return out

    def same(self, x: np.ndarray, y: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Whether the ``n`` numbers from ``x`` are those from ``y``, ``x <= y``."""
        equal = np.ones(len(x), bool)
        for p, power, prefix in self._fields:
            one = (prefix[x + n] + (p - prefix[x])) % p * power[y - x]
            equal &= one % p == (prefix[y + n] + (p - prefix[y])) % p
        return equal

    def after(self, x: np.ndarray, y: np.ndarray, longest: int) -> np.ndarray:
        """Z-values: how many numbers from ``x`` on are those from ``y`` on."""
        n = np.zeros(len(x), np.int64)
        step = 1 << longest.bit_length()
        while step:
            fits = np.flatnonzero(y + n + step <= self.size)
            n[fits] += step * self.same(x[fits] + n[fits], y[fits] + n[fits], step)
            step >>= 1
        return n

    def before(self, x: np.ndarray, y: np.ndarray, longest: int) -> np.ndarray:
        """The same to the other side: how many numbers up to ``x`` are those up to ``y``."""
        n = np.zeros(len(x), np.int64)
        step = 1 << longest.bit_length()
        while step:
            fits = np.flatnonzero(x - n - step >= 0)
            n[fits] += step * self.same(x[fits] - n[fits] - step, y[fits] - n[fits] - step, step)
            step >>= 1
        return n


# -- runs of tiles -------------------------------------------------------------


def _agreeing(blocks: np.ndarray, low: int, back: int) -> np.ndarray:
    """Numbers ``b + q - low`` of the boundaries b and shifts q of an octave whose blocks ``back`` before them agree."""
    first = -(-back // low)
    head = blocks[first * low - back :: low]
    rest = blocks[first * low - back + low :]
    full = len(rest) // low
    found = [np.flatnonzero(rest[: full * low].reshape(full, low) == head[:full, None])]
    if len(rest) % low:
        found.append(full * low + np.flatnonzero(rest[full * low :] == head[full]))
    return np.concatenate(found) + first * low


def _known(at: np.ndarray, shift: np.ndarray, found: list[np.ndarray], low: int) -> np.ndarray:
    """Which candidates (ascending) lie in a run found before, at a multiple of its period."""
    inside = np.zeros(len(at), bool)
    for start, stop, period in (run for runs in found for run in runs[runs[:, 1] - runs[:, 0] >= 2 * low].tolist()):
        part = slice(*np.searchsorted(at, (start, stop)))
        inside[part] |= (shift[part] % period == 0) & (at[part] + shift[part] <= stop)
    return inside


def _primitive(stretches: _Stretches, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether the first ``period`` numbers are not a shorter stretch several times over."""
    keep, left, divisor = np.ones(len(start), bool), period.copy(), 2
    while len(left) and divisor * divisor <= left.max():
        hit = np.flatnonzero(left % divisor == 0)
        if len(hit):
            part = period[hit] // divisor
            keep[hit] &= ~stretches.same(start[hit], start[hit] + part, period[hit] - part)
            while len(hit):
                left[hit] //= divisor
                hit = hit[left[hit] % divisor == 0]
        divisor += 1
    hit = np.flatnonzero(left > 1)
    part = period[hit] // left[hit]
    keep[hit] &= ~stretches.same(start[hit], start[hit] + part, period[hit] - part)
    return keep


def runs_of(numbers: np.ndarray, ends: np.ndarray, low: int, high: int, shortest: int = SHORTEST) -> np.ndarray:
    """Rows (start, stop, period) of the runs in tiles laid end to end, with ``low <= period < high``.

    ``ends`` are the ends of the tiles; ``low`` is a power of two. Starts count from the first tile.
    """
    lengths = np.diff(ends, prepend=0)
    tile = np.repeat(np.arange(len(ends)), lengths)
    # A number of its own behind each tile, so that nothing agrees across it.
    spaced = np.empty(len(numbers) + len(ends), np.int64)
    spaced[np.arange(len(numbers)) + tile] = numbers
    spaced[ends + np.arange(len(ends))] = -2 - np.arange(len(ends))
    longest = int(lengths.max(initial=0))
    stretches = _Stretches(spaced)
    found: list[np.ndarray] = []
    while low < high and 2 * low <= longest:
        period = np.arange(low, min(2 * low, high))
        width = min(8, 1 << (int(np.maximum(period, shortest - period).min() + 1) // 2).bit_length() - 1)
        blocks = stretches.blocks(width)
        candidates = np.union1d(_agreeing(blocks, low, 0), _agreeing(blocks, low, width))
        octave = []
        for k in range(0, len(candidates), _SLICE):
            code = candidates[k : k + _SLICE]
            at, shift = code // low * low, code % low + low
            open_ = (shift < high) & (at + shift < len(spaced))
            open_ &= ~_known(at, shift, found, low)
            at, shift = at[open_], shift[open_]
            left = stretches.before(at, at + shift, longest)
            right = stretches.after(at, at + shift, longest)
            good = left + right >= np.maximum(shift, shortest - shift)
            rows = np.stack([at - left, at + shift + right, shift], 1)[good]
            octave.append(np.unique(rows, axis=0))
        rows = np.unique(np.concatenate(octave), axis=0) if octave else np.zeros((0, 3), np.int64)
        found.append(rows[_primitive(stretches, rows[:, 0], rows[:, 2])])
        low *= 2
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    shift = np.searchsorted(ends + np.arange(len(ends)), rows[:, 0], side="right")
    return rows - np.stack([shift, shift, np.zeros_like(shift)], 1)


# -- documents of one tile -----------------------------------------------------


def _listed(runs: np.ndarray, ends: np.ndarray, firsts: np.ndarray) -> pa.Array:
    """Runs (ascending) as one array of (start, length, period) per document."""
    doc = np.searchsorted(ends, runs[:, 0], side="right")
    offsets = np.searchsorted(doc, np.arange(len(ends) + 1)).astype(np.int32)
    columns = [runs[:, 0] - firsts[doc], runs[:, 1] - runs[:, 0], runs[:, 2]]
    values = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_RUN_TYPE))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _collapsed(words: pa.Array, ends: np.ndarray, runs: np.ndarray) -> pa.Array:
    """The words outside of runs and of their first periods, joined by a blank, per document."""
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 1], -1)
    keep = np.cumsum(depth)[:-1] == 0
    kept = np.concatenate([[0], np.cumsum(keep)])
    offsets = np.concatenate([[0], kept[ends]])
    listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.filter(pa.array(keep)))
    return pc.binary_join(listed, pa.scalar(" ", pa.large_string()))


def _portions(texts: pa.Array) -> Iterator[slice]:
    """Consecutive texts of about a megabyte together; a longer text is one portion."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64) + 64
    portion = (np.cumsum(sizes) - sizes) // _PORTION
    edges = np.flatnonzero(np.diff(portion, prepend=-1, append=portion[-1] + 1 if len(portion) else 0))
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield slice(begin, end)


def _whole(shortest: int):
    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch.column(1)):
                rows = batch.slice(part.start, part.stop - part.start)
                words, ends = split_words(rows.column(1))
                numbers = words.dictionary_encode().indices.to_numpy()
                runs = runs_of(numbers, ends, 1, len(numbers) + 1, shortest)
                runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
                counts = np.diff(ends, prepend=0)
                columns = [rows.column(0), pa.array(counts, pa.int64()), _listed(runs, ends, ends - counts)]
                columns.append(_collapsed(words, ends, runs).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    return solve


# -- documents of several tiles ------------------------------------------------


def tiles_of(n: int, tile: int) -> Iterator[tuple[int, int, int, int]]:
    """(first, last, low, high) of the tiles of a document of ``n`` words: where, and for which periods."""
    low, octave = 1, max(1, tile // 8)
    while 2 * low <= n:
        size = max(tile, 8 * octave)
        if n <= size:
            yield 0, n, low, n
            return
        for first in range(0, n - size // 2, size // 2):
            yield first, min(n, first + size), low, 2 * octave
        low = octave = 2 * octave


def _exploded(tile: int):
    def explode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["text_key", "first", "low", "high", "numbers"]
        for batch in batches:
            for k in range(batch.num_rows):
                words, _ = split_words(batch.column(1).slice(k, 1))
                numbers = words.dictionary_encode().indices.to_numpy().astype("<i4")
                for first, last, low, high in tiles_of(len(numbers), tile):
                    row = [batch.column(0)[k].as_py(), first, low, high, numbers[first:last].tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=names)

    return explode


def _solved(shortest: int):
    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                numbers = np.frombuffer(row["numbers"], "<i4")
                runs = runs_of(numbers, np.array([len(numbers)]), row["low"], row["high"], shortest)
                columns = [pa.array([row["text_key"]] * len(runs), pa.string())]
                columns += [pa.array(c, pa.int64()) for c in (runs[:, 2], runs[:, 0] + row["first"], runs[:, 1] + row["first"])]
                yield pa.RecordBatch.from_arrays(columns, names=["text_key", "period", "start", "stop"])

    return solve


def stitched(pieces: DataFrame) -> DataFrame:
    """(text_key, period, start, stop) of whole runs from those of their pieces.

    Pieces of one document and period that overlap by a period belong to one run.
    """
    group = Window.partitionBy("text_key", "period")
    order = group.orderBy("start", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("start") + F.col("period") <= reached, 0).otherwise(1)
    numbered = pieces.distinct().withColumn("new", new).withColumn("run", F.sum("new").over(order))
    return numbered.groupBy("text_key", "period", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")


def _joined():
    def collapse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                words, ends = split_words(row.column(1))
                listed = row.column(2).to_pylist()[0] or []
                runs = np.array([[r["start"], r["start"] + r["length"], r["period"]] for r in listed], np.int64).reshape(-1, 3)
                columns = [row.column(0), pa.array([len(words)], pa.int64()), pa.array([listed], pa.list_(_RUN_TYPE))]
                columns.append(_collapsed(words, ends, runs).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    return collapse


def find_runs(
    docs: DataFrame, shortest: int = SHORTEST, tile: int = TILE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period, in words, by start and
    period) and collapsed, the text without the words of a run behind its first period.

    A null or empty text has no words, no runs and an empty collapsed text. Repeated rows and null ids
    are kept; other columns are left out. An empty table gives an empty result. The memory of a task
    follows the longest document (some 60 bytes a word of a tile), not the table.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    large = F.coalesce(F.octet_length("text"), F.lit(0)) > _BYTES_PER_WORD * tile
    schema = f"doc_id long, n_words long, runs {_RUNS}, collapsed string"
    whole = map_batches(rows.where(~large), _whole(shortest), schema)

    # The few large texts, once: tiled, and collapsed when their runs are known.
    long = stage(rows.where(large).withColumn("text_key", F.md5("text")), "long-texts")
    parts = slots(docs)
    tiles = map_batches(
        long.select("text_key", "text"), _exploded(tile), "text_key string, first long, low long, high long, numbers binary"
    )
    found = map_batches(tiles.repartition(parts), _solved(shortest), "text_key string, period long, start long, stop long")
    run = F.struct("start", "period", (F.col("stop") - F.col("start")).alias("length"))
    listed = F.transform(F.array_sort(F.collect_list(run)), lambda r: F.struct(r["start"], r["length"], r["period"]))
    runs = stitched(found).groupBy("text_key").agg(listed.cast(_RUNS).alias("runs"))
    told = long.join(runs, "text_key", "left").select("doc_id", "text", "runs")
    return whole.unionByName(map_batches(told, _joined(), schema))
