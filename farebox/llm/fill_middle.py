"""Fill-in-middle transformation by piece tables.

A document is a list of descriptors (buffer, start, stop) over two buffers that never change: its text
and the sentinels. Cutting splits a descriptor, an arrangement permutes descriptors and puts sentinels
between them, and nothing is copied until a text is asked for: hashes run over the descriptors. To
restore a document, the output and its form are all that is needed: the sentinels are found in the
output, which becomes the text buffer of a new table, and the inverse arrangement leads back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from farebox.llm.tables import map_batches

TEXT, SENTINELS = 0, 1
MARKS = (b"<P>", b"<S>", b"<M>")
PREFIX, SUFFIX, MIDDLE = range(3)
# The parts of a form in the order of its output, each behind its mark.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
_ORIGINAL = (PREFIX, MIDDLE, SUFFIX)


class Piece(NamedTuple):
    """``stop - start`` bytes of a buffer."""

    buffer: int
    start: int
    stop: int


class Table:
    """A sequence of pieces over a text and the sentinels."""

    def __init__(self, text: bytes, pieces: Sequence[Piece] | None = None):
        self.buffers = (memoryview(text), memoryview(b"".join(MARKS)))
        self.pieces = [Piece(TEXT, 0, len(text))] if pieces is None else list(pieces)

    def cut(self, at: int) -> None:
        """Split the piece that holds byte ``at`` of the sequence in two; one of them may be empty."""
        for k, piece in enumerate(self.pieces):
            if at <= piece.stop - piece.start:
                self.pieces[k : k + 1] = [piece._replace(stop=piece.start + at), piece._replace(start=piece.start + at)]
                return
            at -= piece.stop - piece.start
        raise ValueError("cut behind the end")

    def arranged(self, order: Sequence[int]) -> Table:
        """The pieces in another order."""
        return Table(self.buffers[TEXT], [self.pieces[k] for k in order])

    def slices(self) -> Iterator[memoryview]:
        for buffer, start, stop in self.pieces:
            yield self.buffers[buffer][start:stop]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.slices():
            digest.update(part)
        return digest.hexdigest()

    def text(self) -> bytes:
        return b"".join(self.slices())


def _mark(part: int) -> Piece:
    start = sum(map(len, MARKS[:part]))
    return Piece(SENTINELS, start, start + len(MARKS[part]))


def arrange(text: bytes, first: int, second: int, form: str) -> Table:
    """The output for a text cut at two bytes."""
    table = Table(text)
    if form not in FORMS:
        return table
    table.cut(second)
    table.cut(first)
    # Now prefix, middle, suffix; the marks follow, to be permuted like them.
    table.pieces += [_mark(part) for part in range(len(MARKS))]
    order = [k for part in FORMS[form] for k in (len(_ORIGINAL) + part, _ORIGINAL.index(part))]
    return table.arranged(order)


def restore(output: bytes, form: str) -> Table:
    """The document that has this output in this form."""
    if form not in FORMS:
        return Table(output)
    parts, at = FORMS[form], len(MARKS[FORMS[form][0]])
    if not output.startswith(MARKS[parts[0]]):
        raise ValueError(f"not an output of form {form}")
    found: dict[int, Piece] = {}
    for part, behind in zip(parts, parts[1:]):
        # A mark does not occur in the text and has no part that both begins and ends it, so the first one counts.
        stop = output.index(MARKS[behind], at)
        found[part] = Piece(TEXT, at, stop)
        at = stop + len(MARKS[behind])
    found[parts[-1]] = Piece(TEXT, at, len(output))
    return Table(output, [found[part] for part in _ORIGINAL])


def _chars(part: memoryview) -> int:
    """Code points of UTF-8 text: the bytes that do not continue one."""
    return len(part) - int(np.count_nonzero(np.frombuffer(part, np.uint8) & 0xC0 == 0x80)) if len(part) else 0


def transform(text: bytes, draws: Sequence[int], fim_percent: int, spm_percent: int) -> tuple[int, str, int, int, Table]:
    """(lines, form, first cut, second cut, output) of a text under four draws."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1 if text else np.zeros(0, np.int64)
    if text and (not len(ends) or ends[-1] < len(text)):
        ends = np.append(ends, len(text))
    n = len(ends)
    if not text or any(mark in text for mark in MARKS) or draws[2] % 100 >= fim_percent:
        return n, "plain", 0, 0, arrange(text, 0, 0, "plain")
    form = "spm" if draws[3] % 100 < spm_percent else "psm"
    low, high = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    first, second = (int(ends[k - 1]) if k else 0 for k in (low, high))
    return n, form, first, second, arrange(text, first, second, form)


def draws_of(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers below 2 ** 32; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


_PIECE = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())])
_FIELDS = [
    ("doc_id", pa.int64()),
    ("n", pa.int64()),
    ("form", pa.string()),
    ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()),
    ("output_sha256", pa.string()),
    ("restored_sha256", pa.string()),
    ("pieces", pa.list_(_PIECE)),
    ("output", pa.string()),
]
_TYPES = {
    "doc_id": "long",
    "n": "long",
    "form": "string",
    "prefix_chars": "long",
    "middle_chars": "long",
    "output_sha256": "string",
    "restored_sha256": "string",
    "pieces": "array<struct<buffer:int,start:long,stop:long>>",
    "output": "string",
}
# Texts are rendered, so rows go out before many of them are held.
_HELD = 4 << 20


def _transformer(seed: int, fim_percent: int, spm_percent: int, names: Sequence[str]):
    schema = pa.schema([field for field in _FIELDS if field[0] in names])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0

        def batch_of() -> pa.RecordBatch:
            columns = dict(zip((name for name, _ in _FIELDS), zip(*rows)))
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for doc_id, value in zip(batch.column(0).to_pylist(), texts):
                text = value.as_py() or b""
                n, form, first, second, table = transform(text, draws_of(seed, doc_id), fim_percent, spm_percent)
                view, output = memoryview(text), table.text()
                cut = (_chars(view[:first]), _chars(view[first:second])) if form in FORMS else (None, None)
                back = restore(output, form).sha256()
                shown = ([p._asdict() for p in table.pieces] if "pieces" in names else None, output if "output" in names else None)
                rows.append((doc_id, n, form, *cut, table.sha256(), back, *shown))
                held += len(output) * ("output" in names) + 512
                if held >= _HELD:
                    yield batch_of()
                    rows, held = [], 0
        if rows:
            yield batch_of()

    return work


def fill_in_middle(
    docs: DataFrame,
    seed: int = 7,
    fim_percent: int = 100,
    spm_percent: int = 50,
    with_output: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (lines), form (plain, psm, spm), prefix_chars and
    middle_chars (code points; NULL if plain), output_sha256, restored_sha256 (of the text rebuilt from
    output and form) and, ``with_output``, pieces (buffer 0 is the text, 1 the sentinels one after the
    other; in bytes) and output.

    Where a document is cut follows from ``seed`` and its id, so repeated ids are cut alike; a null id
    counts as an empty one. A null text is an empty one and stays plain, like texts that contain a
    sentinel. Nothing is exchanged. Other columns are left out; an empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    names = [name for name in _TYPES if with_output or name not in ("pieces", "output")]
    schema = ", ".join(f"{name} {_TYPES[name]}" for name in names)
    return map_batches(rows, _transformer(seed, fim_percent, spm_percent, names), schema)

