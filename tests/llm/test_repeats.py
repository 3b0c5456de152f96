"""Repeated bytes of near copies: most runs share an anchor with runs that differ, and are compared window by window."""

from __future__ import annotations

import collections
import random

import numpy as np
import pyarrow as pa

from farebox.llm import repeats

LENGTH = repeats.LENGTH


def _near_copies(n, copies):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        words = ["".join(rng.choices("abcdefghijé", k=rng.randint(1, 9))) for _ in range(rng.randint(20, 160))]
        for k in range(copies):
            rows.append((i + 1000 * k, " ".join(w + "x" * (rng.random() < 0.03) for w in words)))
    return rows


def _left(bodies):
    seen = collections.Counter(b[i : i + LENGTH] for b in bodies for i in range(len(b) - LENGTH + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - LENGTH + 1):
            if seen[b[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone[:-1], [False]]).astype(np.int8)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def test_near_copies(frame):
    rows = [*_near_copies(60, 4), (7, None), (7, ""), (None, "é" * 150), (None, "é" * 150), (8, "short")]
    bodies = [(t or "").encode() for _, t in rows]
    want = [(d, len(b), len(b) - len(kept), spans, kept) for (d, _), b, (spans, kept) in zip(rows, bodies, _left(bodies))]
    docs = frame(rows[:100]).coalesce(1).union(frame(rows[100:]).coalesce(3))
    got = [(r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in repeats.remove_repeats(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert 0 < sum(x[2] for x in want) < sum(x[1] for x in want)


def _asked_of(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["row", "text"])
    settled = pa.Table.from_batches([b for x in repeats._scan(8)([batch]) for b in repeats._settle([x])])
    asked = collections.defaultdict(list)
    for x in settled.to_pylist():
        if x["anchor"] is not None:
            asked[x["row"]].append(x)
    columns = [pa.array(list(asked)), pa.array([texts[r] for r in asked]), pa.array(list(asked.values()))]
    return sum(map(len, asked.values())), pa.RecordBatch.from_arrays(columns, names=["row", "text", "asked"])


def test_runs_of_a_bucket_travel_as_one_record():
    n_runs, batch = _asked_of([t.encode() for _, t in _near_copies(60, 4)])
    cut = pa.Table.from_batches(list(repeats._cut(8)([batch])))
    assert n_runs > 500
    assert cut.num_rows <= 8
    # What an executor gets of a batch that begins in the middle of another is the same.
    parts = pa.Table.from_batches([x for at in range(0, batch.num_rows, 7) for x in repeats._cut(8)([batch.slice(at, 7)])])
    total = lambda t: sum(len(b or b"") for b in t["body"].to_pylist())
    assert total(parts) == total(cut)
    found = [{(r["row"], i) for x in repeats._compare(t.sort_by("bucket").to_batches()) for r in x.to_pylist()
              for i in range(r["begin"], r["until"])} for t in (cut, parts)]
    assert found[0] == found[1] and found[0]


def test_spans_within_a_longer_one_are_part_of_it():
    row, begin, until = repeats._merged(np.array([5, 5, 5, 2]), np.array([0, 10, 60, 70]), np.array([100, 20, 90, 80]))
    assert [row.tolist(), begin.tolist(), until.tolist()] == [[2, 5], [70, 0], [80, 100]]


def test_most_windows_are_told_apart_at_once(monkeypatch):
    sizes = []
    digits = repeats.Hashes.of
    monkeypatch.setattr(repeats.Hashes, "of", lambda self, begin, end: sizes.append(len(begin)) or digits(self, begin, end))
    text = np.random.default_rng(1).integers(0, 256, 40_000).astype(np.uint8)
    text[300:540] = text[:240]
    window = np.arange(len(text) - LENGTH + 1)
    # Windows that are all in one group, as those of a common anchor are: only equal ones go through the passes by block.
    found = repeats.repeated_windows(np.zeros(len(window), np.int64), text, window)
    assert np.flatnonzero(found).tolist() == [*range(41), *range(300, 341)]
    assert sizes == [len(window), 82, 82, 82, 82]
