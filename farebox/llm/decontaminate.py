"""Benchmark decontamination: q-gram lemma filtering and banded alignment.

Benchmark items are cut into overlapping probes: long ones, which bear most edits, and short ones close
together, which an excerpt holds whole. Equal probes of several items are one probe; what holds the same
items is one class. A text region within ``e`` edits of a probe of ``m``
bytes shares at least ``m - q + 1 - e * q`` of its q-grams with it, on diagonals that lie within ``e`` of
each other. Shared q-grams are counted per probe in overlapping bands of diagonals, twice as wide as
that and half a band apart, so one band holds them all. Bands with enough are aligned, many at a time, and
only in their own diagonals. Both sides are lower-cased, with every run of white space as one blank, as UTF-8.
An item too short for that is looked for as it is, between blanks or the ends of a text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from farebox.llm.tables import map_batches, stage
from farebox.llm.tokens import portions

# So short that a probe with all its edits still shares a q-gram, whatever its length.
Q = 10
PROBE_BYTES = 192
# Short probes: two fifths of the item up to so many bytes, at most a quarter of that apart.
PASSAGE_BYTES = 64
SHORTEST = 32
# One edit in so many bytes.
BYTES_PER_EDIT = 16
# Bytes of distinct probes that go into one index, which every task gets.
BLOCK_BYTES = 6 << 20
# Shared q-grams that are looked at together, and regions that are aligned together.
EXPANDED, ALIGNED = 1 << 21, 2048
# Bytes that hold all q-grams a region shares with a probe.
_WINDOW = PROBE_BYTES + 2 * (PROBE_BYTES // BYTES_PER_EDIT + 1)
_B = np.uint64(0x9E3779B97F4A7C15)
_FAR = 1 << 13
_HITS = "doc_id long, item_id long, n_items long, holders long, n_probes int, n_matched int, distance int, begins int"


def normalised(text: str) -> bytes:
    return " ".join(text.lower().split()).encode()


def _hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the ``Q`` bytes from each position, built from halves."""
    one = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    with np.errstate(over="ignore"):
        power, width, held, out = _B, 1, one, None
        for bit in range(Q.bit_length()):
            if Q >> bit & 1:
                if out is None:
                    out, done = held, width
                else:  # what is held, followed by what is done
                    n = len(text) - done - width + 1
                    out = held[: max(n, 0)] * np.uint64(pow(int(_B), done, 1 << 64)) + out[width : width + max(n, 0)]
                    done += width
            n = max(len(held) - width, 0)
            held = held[:n] * power + held[width : width + n]
            power, width = power * power, 2 * width
        return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _parts(text: bytes, size: int, apart: int) -> list[tuple[int, bytes]]:
    """Parts of ``size`` bytes, ``apart`` from each other, and the last one: those of a common beginning or end are equal."""
    last = len(text) - size
    return [(at, text[at : at + size]) for at in [*range(0, last, apart), last]]


def probes_of(text: bytes) -> list[tuple[int, bytes]]:
    """(start, bytes) of the distinct probes of an item: long parts or it all, and short parts; under ``SHORTEST`` bytes it all.

    An excerpt of half an item of 80 bytes or more, or of 80 bytes of any, holds a short one whole.
    """
    if len(text) < SHORTEST:
        return [(0, text)] if text else []
    size = min(PASSAGE_BYTES, max(SHORTEST, 2 * len(text) // 5 // 4 * 4))
    parts = _parts(text, min(len(text), PROBE_BYTES), PROBE_BYTES // 2) + _parts(text, size, size // 4)
    first: dict[bytes, int] = {}
    for at, part in parts:
        first.setdefault(part, at)
    return [(at, part) for part, at in first.items()]


def align(letters: np.ndarray, length: np.ndarray, window: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(edits, lane) of the best place of each probe on ``4 * edits + 2`` diagonals of its text.

    One column per pair: ``letters`` are those of the probes, ``length`` of them count, and ``window`` the bytes from
    the lowest diagonal on, -1 where the text does not reach. The lane is that of the diagonal where the place ends.
    Where more than ``edits`` are needed, some larger number is given.
    """
    n, width = len(length), 4 * edits + 2
    out = window < 0
    # A place is between two bytes: it may stand next to one byte of the text at least.
    none = out.copy()
    none[1:] &= out[:-1]
    penalty = np.where(out, np.int16(_FAR), np.int16(0))
    lane = np.arange(width, dtype=np.int16)[:, None]
    row = np.where(none[:width], np.int16(_FAR), np.int16(0))
    pairs, best, at = np.arange(n), np.full(n, _FAR, np.int64), np.zeros(n, np.int64)
    for i in range(len(letters)):
        # A match or a replacement uses the byte on the diagonal; an omitted byte of the probe keeps the place.
        new = row + (window[i : i + width] != letters[i]) + penalty[i : i + width]
        np.minimum(new[:-1], row[1:] + np.int16(1), out=new[:-1])
        # An extra byte of the text moves along the diagonals.
        row = np.minimum(np.minimum.accumulate(new - lane, axis=0) + lane, np.int16(_FAR))
        row[none[i + 1 : i + 1 + width]] = _FAR
        done = length[pairs] == i + 1
        if done.any():
            at[pairs[done]] = row[:, done].argmin(axis=0)
            best[pairs[done]] = row[:, done].min(axis=0)
        if done.any() or i % 8 == 7:  # go on with those that may still get there
            left = ~done & (row.min(axis=0) <= edits)
            if not left.any():
                break
            if done.any() or 4 * left.sum() < 3 * len(left):
                pairs, row, letters = pairs[left], row[:, left], letters[:, left]
                window, penalty, none = window[:, left], penalty[:, left], none[:, left]
    return best, at


@dataclass
class Index:
    """Q-grams of distinct probes, each of one class of items; short ones apart."""

    classes: list[Any]  # of each probe
    probes: list[bytes]
    n_probes: dict[Any, int]
    keys: np.ndarray
    first: np.ndarray  # of each key in the two below, and their length
    probe_no: np.ndarray
    probe_at: np.ndarray
    present: np.ndarray
    shift: int
    n_long: int

    @classmethod
    def build(cls, items: list[tuple[Any, bytes]]) -> Index:
        """Of items, each a class of its own."""
        return cls.of([(item, probe) for item, text in items for _, probe in probes_of(text)])

    @classmethod
    def of(cls, rows: list[tuple[Any, bytes]]) -> Index:
        """Of (class, probe) rows."""
        rows = sorted(rows, key=lambda row: len(row[1]) < SHORTEST)
        classes, probes = [c for c, _ in rows], [p for _, p in rows]
        n_probes: dict[Any, int] = {}
        for c in classes:
            n_probes[c] = n_probes.get(c, 0) + 1
        n_long = sum(len(p) >= SHORTEST for p in probes)
        found = [_hashes(np.frombuffer(p, np.uint8)) for p in probes[:n_long]]
        h = np.concatenate([*found, np.zeros(0, np.uint64)])
        no = np.repeat(np.arange(n_long, dtype=np.int32), [len(x) for x in found])
        at = np.concatenate([*[np.arange(len(x), dtype=np.int32) for x in found], np.zeros(0, np.int32)])
        order = np.argsort(h, kind="stable")
        keys, first = np.unique(h[order], return_index=True)
        bits = max(16, int(16 * len(keys)).bit_length())
        present = np.zeros(1 << bits, bool)
        present[keys >> np.uint64(64 - bits)] = True
        return cls(classes, probes, n_probes, keys, np.append(first, len(h)), no[order], at[order], present, 64 - bits, n_long)

    @property
    def _letters(self) -> np.ndarray:
        """The long probes, one row each."""
        if "_matrix" not in self.__dict__:
            self._matrix = np.zeros((self.n_long, PROBE_BYTES), np.uint8)
            for no, probe in enumerate(self.probes[: self.n_long]):
                self._matrix[no, : len(probe)] = np.frombuffer(probe, np.uint8)
        return self._matrix

    @property
    def _lengths(self) -> np.ndarray:
        if "_sizes" not in self.__dict__:
            self._sizes = np.array([len(p) for p in self.probes[: self.n_long]])
        return self._sizes

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    @property
    def _short(self):
        """Finds the short probes between blanks; one character is one byte."""
        if "_words" not in self.__dict__:
            import ahocorasick

            self._words = ahocorasick.Automaton()
            for no in range(self.n_long, len(self.probes)):
                self._words.add_word(f" {self.probes[no].decode('latin-1')} ", no)
            self._words.make_automaton()
        return self._words

    @property
    def _owners(self) -> np.ndarray:
        """Number of the key and probe of each entry as one ascending number."""
        if "_owned" not in self.__dict__:
            self._owned = np.repeat(np.arange(len(self.keys)) * self.n_long, np.diff(self.first)) + self.probe_no
        return self._owned

    def _regions(self, text: np.ndarray, doc: np.ndarray) -> Iterator[np.ndarray]:
        """Distinct (probe, document, low diagonal, first place in the probe) rows with enough shared q-grams, in portions.

        A q-gram of a template is in many places and probes, so about ``EXPANDED`` pairs of them are looked at
        together: those of a stretch of the text, the next one overlapping it by what one region may span, and
        of a part of the probes if there are still too many.
        """
        h = _hashes(text)
        place = np.flatnonzero(self.present[h >> np.uint64(self.shift)])
        key = np.searchsorted(self.keys, h[place])
        hit = (key < len(self.keys)) & (self.keys[np.minimum(key, len(self.keys) - 1)] == h[place])
        place, key = place[hit], key[hit]
        ends = np.cumsum(self.first[key + 1] - self.first[key])
        begin = 0
        while begin < len(place):
            held = ends[begin - 1] if begin else 0
            end = max(np.searchsorted(ends, held + EXPANDED, "right"), np.searchsorted(place, place[begin] + 2 * _WINDOW))
            parts = int(-(-(ends[end - 1] - held) // EXPANDED))
            for part in range(parts):
                low, high = self.first[key[begin:end]], self.first[key[begin:end] + 1]
                if parts > 1:
                    cuts = [self.n_long * (part + more) // parts for more in (0, 1)]
                    low, high = (np.searchsorted(self._owners, key[begin:end] * self.n_long + cut) for cut in cuts)
                if (high > low).any():
                    yield self._bands(place[begin:end], low, high - low, doc, len(text))
            if end >= len(place):
                break
            begin = np.searchsorted(place, place[end] - _WINDOW)

    def _bands(self, place: np.ndarray, first: np.ndarray, n: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
        entry = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        place = np.repeat(place, n)
        probe, at = self.probe_no[entry].astype(np.int64), self.probe_at[entry]
        diagonal = place - at + PROBE_BYTES
        edits = self._lengths // BYTES_PER_EDIT
        least = np.maximum(self._lengths - Q + 1 - edits * Q, 1)
        step = (edits + 1)[probe]
        out = []
        for half in (0, 1):
            band = (diagonal + half * step) // (2 * step)
            keyed = (probe * (doc[-1] + 1) + doc[place]) * (size + 2 * PROBE_BYTES) + band
            order = np.argsort(keyed, kind="stable")
            begin = np.flatnonzero(np.diff(keyed[order], prepend=-1))
            good = np.diff(begin, append=len(order)) >= least[probe[order[begin]]]
            if half:  # q-grams that are all in one band of the first kind were found there
                lower = diagonal[order] // (2 * step[order])
                good &= np.minimum.reduceat(lower, begin) != np.maximum.reduceat(lower, begin)
            good = order[begin[good]]
            low = band[good] * 2 * step[good] - half * step[good] - PROBE_BYTES
            out.append(np.stack([probe[good], doc[place[good]], low, at[good]], axis=1))
        return np.concatenate(out)

    def search(self, texts: list[str]) -> list[tuple[int, Any, int, int, int]]:
        """(text number, class, probes matched, edits of the best, its place) for each text and class that match."""
        held = [normalised(text) + b"\0" for text in texts]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        if len(self.probes) > self.n_long:
            for no, body in enumerate(held):
                spaced = f" {body[:-1].decode('latin-1')} "
                for last, probe_no in self._short.iter(spaced):
                    best.setdefault((no, probe_no), (0, last - len(self.probes[probe_no]) - 1))
        text = np.frombuffer(b"".join(held), np.uint8)
        if self.n_long and len(text) >= Q:
            sizes = np.array([len(x) for x in held])
            starts = np.cumsum(sizes) - sizes
            for regions in self._regions(text, np.repeat(np.arange(len(held)), sizes)):
                self._verify(regions, text, starts, sizes, best)
        out: dict[tuple[int, Any], list] = {}
        for (no, probe_no), found in sorted(best.items()):
            out.setdefault((no, self.classes[probe_no]), []).append(found)
        return [(no, c, len(found), *min(found)) for (no, c), found in out.items()]

    def _verify(self, regions: np.ndarray, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, best: dict) -> None:
        """Note the least edits and place of each (text, probe) whose regions hold the probe."""
        length = self._lengths[regions[:, 0]]
        # What is shared at the beginning of a probe says nothing of its end, so that is compared first.
        backward = 4 * regions[:, 3] < length
        for edits in np.unique(length // BYTES_PER_EDIT).tolist():
            for back in (False, True):
                group = regions[(length // BYTES_PER_EDIT == edits) & (backward == back)]
                for at in range(0, len(group), ALIGNED):
                    self._align(group[at : at + ALIGNED], edits, back, text, starts, sizes, best)

    def _align(self, group, edits, back, text, starts, sizes, best) -> None:
        probe, no, low = group[:, 0], group[:, 1], group[:, 2] - edits
        length, width = self._lengths[probe], 4 * edits + 2
        row = np.arange(length.max())[:, None]
        letters = self._letters[probe, np.maximum(length - 1 - row, 0) if back else np.minimum(row, PROBE_BYTES - 1)]
        row = np.arange(length.max() + width)[:, None]
        place = low + length + width - 2 - row if back else low + row
        inside = (place >= starts[no]) & (place < starts[no] + sizes[no] - 1)
        window = np.where(inside, text[np.clip(place, 0, len(text) - 1)], np.int16(-1))
        least, lane = align(letters, length, window, edits)
        for k in np.flatnonzero(least <= edits).tolist():
            # Forward the end of the place is known, backward its beginning.
            begin = low[k] + width - 1 - lane[k] if back else low[k] + lane[k]
            found = int(least[k]), int(max(0, begin - starts[no[k]]))
            best[int(no[k]), int(probe[k])] = min(found, best.get((int(no[k]), int(probe[k])), found))


def _item_probes(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item_id, probe) rows."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                probes = [probe for _, probe in probes_of(normalised(body))]
                columns = [pa.array([item] * len(probes), pa.int64()), pa.array(probes, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["item_id", "probe"])

    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    return map_batches(rows.where("text IS NOT NULL"), cut, "item_id long, probe binary").distinct()


def _probe_classes(item_probes: DataFrame) -> DataFrame:
    """One row per distinct probe, with the class of the items that hold it."""
    return item_probes.groupBy("probe").agg(
        F.min("item_id").alias("item_id"),
        F.count(F.lit(1)).alias("n_items"),
        F.bit_xor(F.xxhash64("item_id")).alias("holders"),
    )


def class_items(benchmark: DataFrame) -> DataFrame:
    """The items of each class: holders, n_items and item_id. A null benchmark text has no class."""
    rows = _item_probes(benchmark)
    classes = _probe_classes(rows).select("probe", "holders", "n_items")
    return rows.join(classes, "probe").select("holders", "n_items", "item_id").distinct()


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes over the distinct probes, in blocks of ``BLOCK_BYTES`` that cut no class unless it is larger itself."""
    probes = stage(_probe_classes(_item_probes(benchmark)).sort("holders", "n_items", "item_id", "probe"), "probes")
    block, size, last = [], 0, None
    for row in probes.toLocalIterator():
        key = row.item_id, row.n_items, row.holders
        if size >= BLOCK_BYTES and key != last:
            yield Index.of(block)
            block, size = [], 0
        block.append((key, bytes(row.probe)))
        size, last = size + len(row.probe), key
    if block:
        yield Index.of(block)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document and class of benchmark items that share a passage.

    A class is the items that hold the same probes: item_id (the least), n_items and holders (a hash of them all);
    ``class_items`` lists them. So a passage of many items is one row per document. Then n_probes of the class,
    n_matched of them, distance (edits of the best) and begins (its byte in the normalised text).

    A null or empty text or item matches nothing. An item shorter than ``SHORTEST`` bytes must stand in the text as
    it is, between blanks or ends. Items with a null id are one item. Repeated documents are reported repeatedly.
    An empty table on either side gives an empty result.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = docs.sparkSession.createDataFrame([], _HITS)
    for index in indexes(benchmark):
        found = found.union(map_batches(rows, _finder(index), _HITS))
    return found


def _finder(index: Index):
    kinds = [*[pa.int64()] * 4, *[pa.int32()] * 4]
    names = ["doc_id", "item_id", "n_items", "holders", "n_probes", "n_matched", "distance", "begins"]

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, part in portions(batch.column(1).to_pylist()):
                rows = [
                    (ids[first + no], *key, index.n_probes[key], matched, distance, at)
                    for no, key, matched, distance, at in index.search(part)
                ]
                if rows:
                    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return find


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows that share no passage with the benchmark, with all their columns."""
    at = docs.columns.index(text)
    for index in indexes(benchmark):

        def keep(batches: Iterable[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, part in portions(batch.column(at).to_pylist()):
                    leaked = {hit[0] for hit in index.search(part)}
                    clean = pa.array([no not in leaked for no in range(len(part))], pa.bool_())
                    yield batch.slice(first, len(part)).filter(clean)

        docs = map_batches(docs, keep, docs.schema)
    return docs
