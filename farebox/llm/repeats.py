"""Repeated byte strings: every byte inside a string of ``LENGTH`` bytes that also starts elsewhere.

A depth-limited radix sort of the suffixes, by most-significant-digit passes. Only the first ``LENGTH``
bytes are ordered, and a suffix that is alone after a pass is dropped; what is together after the last
pass is exactly the repeated windows.

The first digit is the window's anchor: of the ``GRAM``-byte strings in it, the one with the least hash.
Equal windows have equal anchors at equal places, and neighbouring windows mostly share one, so a run of
about fifty windows with one anchor moves as one record. The second digit compares whole runs: equal runs
are all repeated. Only runs that share an anchor but differ are sent with their bytes, and their windows
are told apart by place and all their bytes, what is left by blocks of ``BLOCK`` bytes. An anchor with
very many different runs is split by what surrounds it: its windows are dealt by a digit of all their
bytes, equal ones of a task as one record. Digits are compared by 64-bit hashes; where a sort carries
places, by the upper bits, some 45, and windows must agree in every pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from farebox.llm.shingles import mixed
from farebox.llm.tables import flagged, map_batches, slots, stage

LENGTH, GRAM, BLOCK = 200, 100, 50
# Windows of a document that are looked at together; longer documents are cut, with an overlap.
SEGMENT = 1 << 17
# Bytes of runs whose windows are compared together, besides the rest of an anchor.
PART = 1 << 18
_FLUSH = 250_000
# Different runs of an anchor, in a portion of a task or in all, above which its windows are dealt by their bytes.
CROWD, GROUP = 256, 4096
# Groups of windows that a task of the last pass takes one after the other.
FINE = 16
_B = 0x9E3779B97F4A7C15
_RUN = np.dtype([("anchor", "<u8"), ("span", "<u8"), ("row", "<i8"), ("begin", "<u4"), ("lo", "u1"), ("hi", "u1"), ("done", "u1")])
_PIECE = np.dtype([("anchor", "<i8"), ("row", "<i8"), ("begin", "<u4"), ("size", "<u2"), ("lo", "u1"), ("need", "u1")])
_WINDOW = np.dtype([("anchor", "<i8"), ("window", "<u8"), ("row", "<i8"), ("begin", "<u4"), ("need", "u1")])
# Values of ``done``: settled; and standing for an anchor whose runs have gone another way.
_DONE, _MARK = 1, 2
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """B ** i and B ** -i for i below n, and a random value per byte; kept by the process."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(n, SEGMENT << 1).bit_length()
        for name, base in (("up", _B), ("down", pow(_B, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
        _powers["byte"] = mixed(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
    return _powers["up"][:n], _powers["down"][:n], _powers["byte"]


class Hashes:
    """Hashes of any part of a byte string, each in constant time."""

    def __init__(self, text: np.ndarray):
        up, self._down, value = _power(len(text) + 1)
        self._sums = np.zeros(len(text) + 1, np.uint64)
        steps = value.take(text)
        steps *= up[:-1]
        np.cumsum(steps, out=self._sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[begin]) * self._down[begin])

    def all(self, size: int) -> np.ndarray:
        """Of the ``size`` bytes from each position."""
        n = len(self._sums) - size
        return mixed((self._sums[size:] - self._sums[:n]) * self._down[:n])


def _runs(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Hashes]:
    """(anchor, first window, last window) of every run; texts end at ``ends`` and are not crossed."""
    hashes = Hashes(text)
    gram = hashes.all(GRAM)
    at = np.uint64(24)
    low = (gram >> at << at) | np.arange(len(gram), dtype=np.uint64)
    wide = LENGTH - GRAM + 1
    width = 1
    while 2 * width <= wide:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: len(text) - LENGTH + 1], low[wide - width :])
    begins = np.concatenate([[0], ends[:-1]])
    window = np.concatenate([np.arange(b, e - LENGTH + 1) for b, e in zip(begins, ends) if e - b >= LENGTH])
    anchor = (low[window] & np.uint64((1 << 24) - 1)).astype(np.int64)
    change = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)]))
    last = np.append(change[1:], len(window)) - 1
    return anchor[change], window[change], window[last], hashes


def _segments(keys: list[int], texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (row, offset, bytes); every window of every text is in one of them."""
    held, size = [], 0
    for key, text in zip(keys, texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), SEGMENT):
            held.append((key, at, text[at : at + SEGMENT + LENGTH - 1]))
            size += len(held[-1][2])
            if size >= SEGMENT:
                yield held
                held, size = [], 0
    if held:
        yield held


def _records(part: list[tuple[int, int, bytes]]) -> np.ndarray:
    sizes = np.array([len(body) for _, _, body in part])
    ends = np.cumsum(sizes)
    anchor, first, last, hashes = _runs(np.frombuffer(b"".join(body for _, _, body in part), np.uint8), ends)
    which = np.searchsorted(ends, first, side="right")
    out = np.empty(len(anchor), _RUN)
    out["anchor"] = hashes.of(anchor, anchor + GRAM)
    out["lo"], out["hi"], out["done"] = anchor - first, anchor - last, 0
    shape = (anchor - first).astype(np.uint64) * np.uint64(256) + (anchor - last).astype(np.uint64)
    out["span"] = mixed(hashes.of(first, last + LENGTH) + shape * np.uint64(_B))
    out["row"] = np.array([key for key, _, _ in part], np.int64)[which]
    out["begin"] = first - (ends - sizes)[which] + np.array([at for _, at, _ in part])[which]
    return out


def _until(runs: np.ndarray) -> np.ndarray:
    return runs["begin"].astype(np.int64) + runs["lo"] - runs["hi"] + LENGTH


def _sorted(runs: np.ndarray, by: str = "span") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs by anchor and span, with the start of each group of equal ones, and its size."""
    runs = runs[np.lexsort((runs[by], runs["anchor"]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[by][1:] != runs[by][:-1]) | (runs["anchor"][1:] != runs["anchor"][:-1])
    start = np.flatnonzero(new)
    return runs, start, np.diff(np.append(start, len(runs)))


def _anchors(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first run of each anchor, and the number of its runs."""
    first = np.flatnonzero(np.concatenate([[True], kinds["anchor"][1:] != kinds["anchor"][:-1]]))
    return first, np.diff(np.append(first, len(kinds)))


_SCHEMA = "bucket int, runs binary, row long, begin long, until long, anchor long, lo int, hi int, need boolean, crowd boolean"
_NAMES = [field.split()[0] for field in _SCHEMA.split(", ")]
_KINDS = [pa.int32(), pa.binary(), *[pa.int64()] * 4, pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]


def _batch(n: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[x], t) if x in columns else pa.nulls(n, t) for x, t in zip(_NAMES, _KINDS)]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def _merged(row: np.ndarray, begin: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, until) of covered spans; those of a row that touch are one."""
    order = np.lexsort((begin, row))
    row, begin, until = row[order], begin[order].astype(np.int64), until[order]
    new = np.ones(len(row), bool)
    new[1:] = row[1:] != row[:-1]
    # How far the spans of a row reach so far; rows lie far apart.
    apart = np.cumsum(new) << 33
    new[1:] |= (begin + apart)[1:] > np.maximum.accumulate(until + apart)[:-1]
    first = np.flatnonzero(new)
    return row[first], begin[first], np.maximum.reduceat(until, first) if len(first) else until


def _spans_of(runs: np.ndarray, buckets: int) -> pa.RecordBatch:
    row, begin, until = _merged(runs["row"], runs["begin"], _until(runs))
    return _batch(len(row), bucket=row % buckets, row=row, begin=begin, until=until)


def _asked(kinds: np.ndarray, need: np.ndarray, crowd: np.ndarray, buckets: int) -> pa.RecordBatch:
    return _batch(
        len(kinds),
        bucket=kinds["row"] % buckets,
        row=kinds["row"],
        begin=kinds["begin"],
        until=_until(kinds),
        anchor=kinds["anchor"].view(np.int64),
        lo=kinds["lo"],
        hi=kinds["hi"],
        need=need,
        crowd=crowd,
    )


def _scan(buckets: int):
    """First pass: runs by anchor, packed by bucket. Runs that are repeated within the task already are
    settled, and only one of them goes on. Of an anchor with a crowd of runs one goes on as a mark, and
    all are asked for at once; they do not meet."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            runs, start, size = _sorted(np.concatenate(held))
            again = np.repeat(size > 1, size)
            if again.any():
                yield _spans_of(runs[again], buckets)
            sent = runs[start]
            sent["done"] = np.where(size > 1, _DONE, 0)
            first, several = _anchors(sent)
            if (several > CROWD).any():
                crowd = np.repeat(several > CROWD, several)
                marks = sent[first[several > CROWD]]
                marks["done"] = _DONE | _MARK
                runs = sent[crowd]
                yield _asked(runs, runs["done"] == 0, np.ones(len(runs), bool), buckets)
                sent = np.concatenate([sent[~crowd], marks])
            bucket = (sent["anchor"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            sent, bucket = sent[order], bucket[order]
            used, first = np.unique(bucket, return_index=True)
            yield _batch(len(used), bucket=used, runs=[_packed(x) for x in np.split(sent, first[1:])])

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for part in _segments(keys, texts):
                held.append(_records(part))
                count += len(held[-1])
                if count >= _FLUSH:
                    yield from flush()
                    held, count = [], 0
        if held:
            yield from flush()

    return run


def _packed(runs: np.ndarray) -> bytes:
    """Field after field; like values together compress better."""
    return b"".join(np.ascontiguousarray(runs[name]).tobytes() for name in runs.dtype.names)


def _unpacked(body: bytes, record: np.dtype = _RUN) -> np.ndarray:
    runs, at = np.empty(len(body) // record.itemsize, record), 0
    for name in record.names:
        kind = record[name]
        runs[name] = np.frombuffer(body, kind, len(runs), at)
        at += kind.itemsize * len(runs)
    return runs


def _settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second pass: equal runs are repeated; unequal ones with one anchor are asked for."""
    held = []
    for batch in batches:
        packed = batch.column(1).is_valid()
        held += [_unpacked(body) for body in batch.column(1).filter(packed).to_pylist()]
        passed = batch.filter(batch.column(1).is_null())
        if passed.num_rows:
            yield passed
    if not held:
        return
    runs, start, size = _sorted(np.concatenate(held))
    again = np.repeat(size > 1, size)
    if (found := runs[again & (runs["done"] == 0)]).size:
        yield _spans_of(found, 1)
    # One run of each kind, where an anchor has several kinds and not all are settled.
    kinds, open_ = runs[start], (size == 1) & (runs["done"][start] == 0)
    marks = np.logical_or.reduceat(runs["done"] & _MARK != 0, start)
    first, several = _anchors(kinds)
    crowd = np.repeat((several > GROUP) | np.logical_or.reduceat(marks, first), several)
    # A marked kind was asked for where it was marked.
    asked = np.repeat((several > 1) & np.logical_or.reduceat(open_, first), several) & ~marks
    if asked.any():
        yield _asked(kinds[asked], open_[asked], crowd[asked], 1)


def _windows(pieces: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The piece of every window, and where the window begins in the text of all pieces."""
    size = pieces["size"].astype(np.int64)
    count = size - LENGTH + 1
    piece = np.repeat(np.arange(len(pieces)), count)
    return piece, np.arange(count.sum()) + np.repeat(np.cumsum(size) - size - (np.cumsum(count) - count), count)


def _in_order(pieces: np.ndarray, body: bytes, order: np.ndarray) -> list[memoryview]:
    """The bytes of the pieces, which lie end to end in ``body``, in another order."""
    until = np.cumsum(pieces["size"], dtype=np.int64)
    begin, view = until - pieces["size"], memoryview(body)
    return [view[b:u] for b, u in zip(begin[order].tolist(), until[order].tolist())]


_CUT = "bucket long, pieces binary, body binary, row long, begin long, until long, windows binary"
_CUT_NAMES = [field.split()[0] for field in _CUT.split(", ")]
_CUT_KINDS = [pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 3, pa.binary()]


def _cut_batch(n: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[x], t) if x in columns else pa.nulls(n, t) for x, t in zip(_CUT_NAMES, _CUT_KINDS)]
    return pa.RecordBatch.from_arrays(arrays, names=_CUT_NAMES)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[memoryview]]]:
    """(pieces, which are of a crowd, bytes of each) for the runs asked of (row, text, asked), some at a time."""
    text, asked = batch.column(1).cast(pa.binary()), batch.column(2)
    each = asked.flatten()
    field = {f.name: c.to_numpy(zero_copy_only=False) for f, c in zip(each.type, each.flatten())}
    doc = np.repeat(np.arange(batch.num_rows), asked.value_lengths().to_numpy())
    out = np.empty(len(doc), _PIECE)
    for name in ("anchor", "begin", "lo", "need"):
        out[name] = field[name]
    out["row"], out["size"] = batch.column(0).to_numpy()[doc], field["until"] - field["begin"]
    _, offsets, data = text.buffers()
    view = memoryview(data)
    begin = np.frombuffer(offsets, np.int32)[text.offset :][doc] + field["begin"]
    until = begin + out["size"]
    group = np.cumsum(out["size"], dtype=np.int64) // SEGMENT
    for part in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(group)) + 1):
        yield out[part], field["crowd"][part], [view[b:u] for b, u in zip(begin[part].tolist(), until[part].tolist())]


def _cut(buckets: int):
    """The bytes of the runs that are asked for, packed by the bucket of their anchor; of crowds the windows, packed
    by a bucket of their own. Windows repeated within the task are settled, and only one of them goes on."""

    def pack(pieces: np.ndarray, body: bytes) -> Iterator[pa.RecordBatch]:
        bucket = pieces["anchor"] % buckets
        order = np.argsort(bucket, kind="stable")
        used, first = np.unique(bucket[order], return_index=True)
        parts = _in_order(pieces, body, order)
        ends = [*first[1:].tolist(), len(parts)]
        bodies = [b"".join(parts[i:j]) for i, j in zip(first.tolist(), ends)]
        yield _cut_batch(len(used), bucket=used, pieces=[_packed(x) for x in np.split(pieces[order], first[1:])], body=bodies)

    def deal(pieces: np.ndarray, body: bytes) -> Iterator[pa.RecordBatch]:
        text = np.frombuffer(body, np.uint8)
        piece, at = _windows(pieces, text)
        windows = np.empty(len(piece), _WINDOW)
        windows["window"] = Hashes(text).of(at, at + LENGTH)
        first = np.cumsum(pieces["size"], dtype=np.int64) - pieces["size"]
        windows["begin"] = pieces["begin"][piece] + (at - first[piece])
        for name in ("anchor", "row", "need"):
            windows[name] = pieces[name][piece]
        windows, start, size = _sorted(windows, "window")
        found = windows[np.repeat(size > 1, size) & (windows["need"] != 0)]
        if len(found):
            row, begin, until = _merged(found["row"], found["begin"], found["begin"].astype(np.int64) + LENGTH)
            yield _cut_batch(len(row), bucket=row % buckets, row=row, begin=begin, until=until)
        sent = windows[start]
        sent["need"][size > 1] = 0
        bucket = (sent["window"] % np.uint64(buckets * FINE)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sent, bucket = sent[order], bucket[order]
        used, first = np.unique(bucket, return_index=True)
        yield _cut_batch(len(used), bucket=buckets + used, windows=[_packed(x) for x in np.split(sent, first[1:])])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Runs that meet others of their anchor, and those of crowds.
        ways = ((False, pack, 1 << 23, []), (True, deal, 1 << 21, []))
        for batch in batches:
            for pieces, crowd, parts in _pieces(batch):
                for kind, send, most, held in ways:
                    of = np.flatnonzero(crowd == kind)
                    if len(of):
                        held.append((pieces[of], b"".join(parts if len(of) == len(parts) else [parts[i] for i in of.tolist()])))
                    if sum(len(body) for _, body in held) >= most:
                        yield from send(np.concatenate([x for x, _ in held]), b"".join(x for _, x in held))
                        held.clear()
        for _, send, _, held in ways:
            if held:
                yield from send(np.concatenate([x for x, _ in held]), b"".join(x for _, x in held))

    return run


def repeated_windows(group: np.ndarray, text: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Which windows of ``text`` equal another of their group: a pass by all their bytes, then one radix pass per
    block over what is still together; singles are dropped after each."""
    left, rank, hashes = np.arange(len(window)), group.astype(np.uint64), Hashes(text)
    for begin, end in ((0, LENGTH), *((at, at + BLOCK) for at in range(0, LENGTH, BLOCK))):
        at = window[left]
        key = hashes.of(at + begin, at + end)
        if end - begin < LENGTH and not ((key[1:] != key[:-1]) & (rank[1:] == rank[:-1])).any():
            continue  # it tells none apart
        key = mixed(key + rank * np.uint64(_B))
        # Sorted with their places in the low bits; that is faster than sorting places.
        bits = np.uint64(len(key).bit_length())
        key = (key >> bits << bits) | np.arange(len(key), dtype=np.uint64)
        key.sort()
        order = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        key >>= bits
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        several = ~new
        several[:-1] |= ~new[1:]
        left, rank = left[order[several]], np.cumsum(new)[several].astype(np.uint64)
    out = np.zeros(len(window), bool)
    out[left] = True
    return out


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last passes: windows of the runs of an anchor, by place and bytes; those of crowds by their digit.
    Rows come sorted by bucket."""
    held: list[tuple[bytes, bytes]] = []
    packed: list[bytes] = []
    bucket = None

    def covered(row: np.ndarray, begin: np.ndarray, until: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (row, begin, until)], names=["row", "begin", "until"])

    def settle() -> Iterator[pa.RecordBatch]:
        windows, _, size = _sorted(np.concatenate([_unpacked(body, _WINDOW) for body in packed]), "window")
        found = windows[np.repeat(size > 1, size) & (windows["need"] != 0)]
        yield covered(*_merged(found["row"], found["begin"], found["begin"].astype(np.int64) + LENGTH))

    def meet() -> Iterator[pa.RecordBatch]:
        pieces, body = np.concatenate([_unpacked(x, _PIECE) for x, _ in held]), b"".join(x for _, x in held)
        order = np.argsort(pieces["anchor"], kind="stable")
        parts, pieces = _in_order(pieces, body, order), pieces[order]
        # Whole anchors, some at a time.
        first, several = _anchors(pieces)
        group = np.repeat((np.cumsum(pieces["size"], dtype=np.int64) // PART)[first], several)
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(pieces)]
        found = [x for i, j in zip(edges, edges[1:]) for x in again(pieces[i:j], b"".join(parts[i:j]))]
        if found:
            yield covered(*_merged(*(np.concatenate(c) for c in zip(*found))))

    def again(pieces: np.ndarray, body: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        text = np.frombuffer(body, np.uint8)
        run, window = _windows(pieces, text)
        place = window - (np.cumsum(pieces["size"], dtype=np.int64) - pieces["size"])[run]
        first, several = _anchors(pieces)
        anchor = np.repeat(np.arange(len(first)), several)
        at = repeated_windows(anchor[run] * LENGTH + pieces["lo"][run] - place, text, window)
        at = np.flatnonzero(at & (pieces["need"][run] != 0))
        if len(at):
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (run[at[1:]] != run[at[:-1]])
            head, tail = at[new], np.append(at[np.flatnonzero(new)[1:] - 1], at[-1])
            base = pieces["begin"][run[head]].astype(np.int64)
            yield pieces["row"][run[head]], base + place[head], base + place[tail] + LENGTH

    for batch in batches:
        passed = batch.filter(batch.column(3).is_valid())
        if passed.num_rows:
            yield passed.select(["row", "begin", "until"])
        dealt = batch.filter(batch.column(3).is_null())
        for now, pieces, body, windows in zip(*(dealt.column(i).to_pylist() for i in (0, 1, 2, 6))):
            if now != bucket:
                if held:
                    yield from meet()
                if packed:
                    yield from settle()
                held, packed, bucket = [], [], now
            if windows is None:
                held.append((pieces, body))
            else:
                packed.append(windows)
    if held:
        yield from meet()
    if packed:
        yield from settle()


def _finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            # A copy that begins at its first byte, and has one for nulls too.
            text = pa.concat_arrays([batch.column(1).cast(pa.binary()).fill_null(b""), pa.array([b""])])
            _, offsets, data = text.buffers()
            ends = np.frombuffer(offsets, np.int32)[: batch.num_rows + 1].astype(np.int64)
            size, spans = np.diff(ends), batch.column(2)
            each = spans.flatten()
            begin, until = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in each.flatten())
            doc, begin, until = _merged(np.repeat(np.arange(batch.num_rows), spans.value_lengths().fill_null(0).to_numpy()), begin, until)
            gone = np.zeros(batch.num_rows, np.int64)
            np.add.at(gone, doc, until - begin)
            # What is left lies between the spans, in the order of the texts.
            left = zip(np.sort(np.append(ends[:-1], ends[doc] + until)).tolist(), np.sort(np.append(ends[doc] + begin, ends[1:])).tolist())
            view = memoryview(data or b"")
            kept = b"".join([view[b:u] for b, u in left if b < u])
            listed = pa.ListArray.from_arrays(
                np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32),
                pa.StructArray.from_arrays([pa.array(begin), pa.array(until)], names=["begin", "until"]),
            )
            starts = np.concatenate([[0], np.cumsum(size - gone)]).astype(np.int32)
            kept = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(starts), pa.py_buffer(kept)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(gone), listed, kept], names=names)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, spans (removed, maximal) and kept (the other bytes).

    Offsets are bytes of the text as UTF-8; ``kept`` need not be valid UTF-8. A null text counts as
    empty; texts shorter than ``LENGTH`` keep all. Rows are told apart by id and text together, so
    ids may repeat or be null; equal rows repeat each other. Other columns are left out. An empty
    table gives an empty result.
    """
    id_, body = F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    rows = docs.select(id_, body).withColumn("row", F.xxhash64("doc_id", "text"))
    parts = slots(docs)
    long = rows.where(F.octet_length("text") >= LENGTH).select("row", "text")
    scanned = map_batches(long, _scan(parts), _SCHEMA).repartition(parts, "bucket")
    settled = stage(map_batches(scanned, _settle, _SCHEMA).drop("bucket", "runs"), "settled")
    asked = settled.where("anchor IS NOT NULL")
    each = asked.groupBy("row").agg(F.collect_list(F.struct("begin", "until", "anchor", "lo", "need", "crowd")).alias("asked"))
    wanted = flagged(long, asked, "row").where("maybe").drop("maybe")
    bodies = wanted.join(each, "row").select("row", "text", "asked")
    cut = map_batches(bodies, _cut(parts), _CUT).repartition(parts, "bucket").sortWithinPartitions("bucket")
    compared = map_batches(cut, _compare, "row long, begin long, until long")
    covered = settled.where("anchor IS NULL").select("row", "begin", "until").union(compared)
    covered = stage(covered, "covered")
    possible = flagged(rows, covered, "row")
    spans = covered.groupBy("row").agg(F.collect_list(F.struct("begin", "until")).alias("spans"))
    some = possible.where("maybe").join(spans, "row", "left").select("doc_id", "text", "spans")
    none = possible.where("NOT maybe").select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<begin: long, until: long>>, kept binary"
    return map_batches(some.union(none), _finish, schema)
