"""Packing of tokenised documents into sequences of a fixed length.

Bounded-space best fit: a fixed number of sequences is open. A bit set holds which amounts of free space
occur among them, so the tightest open sequence that can take a piece is found by one shift and one
lowest set bit. When all places are taken, the fullest open sequence is closed for a new one. Pieces
arrive in windows of bounded size, the longest of a window first.

Every task packs the documents it reads. No rows are exchanged, and a task leaves at most a few
sequences that are not full, whatever its size.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from farebox.llm.tables import map_batches
from farebox.llm.tokens import batch_rows, encoder, words

CAPACITY = 4096
OPEN = 2048
WINDOW = 8192
_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_ARROW = {
    "doc_id": pa.int64(),
    "piece": pa.int32(),
    "start": pa.int64(),
    "length": pa.int64(),
    "ids_crc32": pa.int64(),
    "sequence_id": pa.int64(),
    "offset": pa.int64(),
    "ids": pa.binary(),
}


class OpenSequences:
    """The open sequences, by free space."""

    def __init__(self, capacity: int, places: int, first: int = 0):
        self._capacity, self._places, self._next = capacity, places, first
        self._free: dict[int, list[int]] = {}
        self._bits = self._open = 0

    def _take(self, free: int) -> int:
        held = self._free[free]
        sequence = held.pop()
        if not held:
            self._bits ^= 1 << free
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece of 1 to ``capacity`` tokens."""
        fitting = self._bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            if self._open == self._places:
                self._take((self._bits & -self._bits).bit_length() - 1)
                self._open -= 1
            free, sequence = self._capacity, self._next
            self._next += 1
            self._open += 1
        left = free - length
        if left:
            self._free.setdefault(left, []).append(sequence)
            self._bits |= 1 << left
        else:
            self._open -= 1
        return sequence, self._capacity - free


def pieces_of(ids: bytes, capacity: int) -> Iterator[tuple[int, bytes]]:
    """(start, ids) of the pieces of a document's ids; only documents over ``capacity`` are cut."""
    for at in range(0, len(ids), 4 * capacity):
        yield at // 4, ids[at : at + 4 * capacity]


def _packer(path: str, cut: Callable, end_id: int, capacity: int, places: int, window: int, with_ids: bool):
    end = end_id.to_bytes(4, "little")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, cut).encode
        task = TaskContext.get()
        bins = OpenSequences(capacity, places, (task.partitionId() if task else 0) << 36)
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            held.sort(key=lambda row: -row[3])
            rows = [(*row[:5], *bins.place(row[3]), row[5]) for row in held]
            held.clear()
            columns = zip(*rows)
            names = list(_ARROW) if with_ids else list(_ARROW)[:-1]
            return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[n]) for n, c in zip(names, columns)], names=names)

        for doc_ids, texts in (rows for batch in batches for rows in batch_rows(batch)):
            for doc_id, ids in zip(doc_ids, encode(texts)):
                for k, (start, piece) in enumerate(pieces_of(ids + end, capacity)):
                    kept = piece if with_ids else None
                    held.append((doc_id, k, start, len(piece) // 4, zlib.crc32(piece), kept))
            if len(held) >= window:
                yield flush()
        if held:
            yield flush()

    return pack


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    cut: Callable[[str], list[str]] = words,
    end_id: int = 1,
    capacity: int = CAPACITY,
    places: int = OPEN,
    window: int = WINDOW,
    with_ids: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked, ids.

    ``tokenizer`` is a file of the tokenizers library that every executor has; ``cut`` splits a text
    where its vocabulary never merges. ``ids`` are little-endian unsigned 32-bit integers. A null or
    empty text is the end id alone. Repeated rows and null ids are packed like any other; columns
    beside the two are left out. An empty table gives an empty result. Sequence numbers are unique but
    not consecutive: the task is in the upper bits.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = _SCHEMA + (", ids binary" if with_ids else "")
    return map_batches(rows, _packer(tokenizer, cut, end_id, capacity, places, window, with_ids), schema)
