"""Periodic runs, source mixing and fill-in-middle against plain versions, on the small corpus."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from farebox.llm import fill_middle, mixing, periodic_runs, queries

EMPTY = [(5, ""), (5, ""), (None, None), (6, None), (None, "some text here")]


@pytest.fixture(scope="module")
def rows(corpus):
    return corpus + EMPTY + [corpus[0]]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- periodic runs ---------------------------------------------------------------


def plain_runs(words, shortest=12):
    """(start, length, period) by trying every period at every place."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(shortest, 2 * q):
                found.setdefault((start, i + q - start), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


@pytest.fixture(scope="module")
def loops():
    rng = random.Random(11)
    texts = []
    for k in range(120):
        words = [f"w{rng.randrange(rng.choice([1, 2, 3, 40]))}" for _ in range(rng.randint(0, 200))]
        if len(words) > 20 and k % 2:
            at = rng.randrange(len(words) - 12)
            period = 1 + (len(words) - at) // rng.randint(2, 9)
            for i in range(at, len(words)):
                words[i] = words[at + (i - at) % period]
        texts.append(rng.choice([" ", "\n", " \t", "  "]).join(words))
    # Fibonacci words have the most runs; a power of a power has the least period of its root.
    a, b = "a", "a b"
    for _ in range(10):
        a, b = b, b + " " + a
    texts += [b, "x " * 300, "u v " * 100 + "u", "a b a b c " * 30, "é　 é　 " * 9, "one two three four five six " * 2]
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("tile", [24, 64, 8192])
def test_runs(frame, rows, loops, tile):
    """Small tiles cut most of the texts, so that pieces have to be stitched."""
    data = loops + [(i, t) for i, t in rows if len(t or "") < 2000]
    got = periodic_runs.find_runs(frame(data), tile=tile).collect()
    want = collections.Counter()
    for doc_id, text in data:
        words = words_of(text)
        runs = plain_runs(words)
        want[doc_id, len(words), tuple(runs), plain_collapsed(words, runs)] += 1
    assert collections.Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in got) == want
    assert sum(len(r.runs) for r in got) > 100


def test_runs_of_no_documents(frame):
    assert periodic_runs.find_runs(frame([])).count() == 0


def test_runs_of_a_very_long_text(frame):
    rng = random.Random(5)
    words = [rng.choice("abcdefghij") + str(rng.randrange(3)) for _ in range(60_000)]
    loop = words[:21_000] + words[20_000:21_000] * 20 + words[21_000:]
    got = periodic_runs.find_runs(frame([(1, " ".join(loop)), (2, "z " * 50_000)]), tile=1024).collect()
    long, one = sorted(got, key=lambda r: r.doc_id)
    assert (20_000, 21_000, 1000) in {(r.start, r.length, r.period) for r in long.runs}
    assert [tuple(r) for r in one.runs] == [(0, 50_000, 1)] and one.collapsed == "z"


def test_tiles_hold_every_stretch_of_two_periods():
    for n in (3, 25, 100, 257, 1000, 5000):
        tiles = list(periodic_runs.tiles_of(n, 24))
        for period in range(1, n // 2 + 1):
            spans = [(first, last) for first, last, low, high in tiles if low <= period < high or (high == n and low <= period)]
            for at in {0, n // 3, n // 2, n - max(12, 2 * period)}:
                if 0 <= at <= n - max(12, 2 * period):
                    assert any(first <= at and at + max(12, 2 * period) <= last for first, last in spans), (n, period, at)


def test_run_query_keeps_its_contract(spark, frame, rows, tmp_path):
    data = [(i, t) for i, t in rows if len(t or "") < 2000]
    data += [(i, data[i % len(data)][1]) for i in range(1000, 1060)]
    frame(data).write.parquet(str(tmp_path / "documents.parquet"))
    want = collections.Counter()
    for doc_id, text in data:
        words = words_of(text)
        h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want[doc_id, len(runs), *told, digest(listed), digest(plain_collapsed(words, runs))] += 1
    got = queries.op11_periodic_runs(spark, str(tmp_path))
    assert dict(got.dtypes) == {c: "string" if c.endswith("sha256") else "bigint" for c in got.columns}
    assert collections.Counter(tuple(r) for r in got.collect()) == want


# -- mixing -----------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by resharing the excess until none is left."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    pool, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if pool * weight[s] / total > most * sizes[s]}
        if not over:
            return target | {s: pool * weight[s] / total for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            pool -= target[s]
        open_ -= over
    return target


def mix_frame(spark, rows, names):
    rng = random.Random(2)
    data = [(i, t, rng.choice(names)) for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS copies")


@pytest.mark.parametrize("names", [["a"], ["b", "a", None, "Z", "é", "", "zz"], [None]])
def test_mix(spark, rows, names):
    data = [(i, t) for i, t in rows * 3]
    docs = mix_frame(spark, data, names)
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r.source] += len(words_of(r.text))
    target = plain_targets(sizes)
    mixes = [mixing.mix_sources(docs.repartition(n), bucket_rows=rows_, fan=fan) for n, rows_, fan in ((3, 16, 3), (7, 16, 3))]
    one, two = (collections.Counter(tuple(r) for r in m.collect()) for m in mixes)
    assert one == two, "reruns agree however the rows are dealt"
    columns = mixes[0].columns
    assert collections.Counter((r[0], r[1], r[2]) for r in one.elements()) == collections.Counter(
        (r.doc_id, r.source, len(words_of(r.text))) for r in docs.collect()
    )
    taken, largest = collections.Counter(), collections.Counter()
    for row in one.elements():
        r = dict(zip(columns, row))
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        expected = r["target"] / r["source_size"]
        assert r["copies"] in (int(expected + 1e-9), int(expected + 1e-9) + 1) and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s]


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_sources(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (2, "", None)], empty.schema)
    assert [(r["size"], r.target, r.copies) for r in mixing.mix_sources(blank).collect()] == [(0, 0.0, 0)] * 3


def test_transfer_keeps_words_and_probabilities():
    rng = random.Random(4)
    for _ in range(500):
        m, n = rng.randint(1, 50), rng.randint(1, 50)
        a, b = rng.uniform(0.01, 0.99), rng.uniform(0.01, 0.99)
        up, down = min(m * (1 - a), n * b), min(m * a, n * (1 - b))
        results = [(mixing.transfer(m, a, n, b, luck), p) for luck, p in ((0.0, down / (up + down)), (1.0, up / (up + down)))]
        for (x, y), _ in results:
            assert m * x + n * y == pytest.approx(m * a + n * b) and 0 <= x <= 1 and 0 <= y <= 1
            assert x in (0, 1) or y in (0, 1)
        assert sum(x * p for (x, _), p in results) == pytest.approx(a)
        assert sum(y * p for (_, y), p in results) == pytest.approx(b)


def test_every_document_keeps_its_probability():
    rng = random.Random(9)
    base = {"source_size": 0, "target": 0.0, "base": 0, "node": 0, "copies": None}
    docs = [base | {"doc_id": i, "source": "ab"[i // 15], "size": rng.randint(1, 30)} for i in range(30)]
    chances, seen, runs = {"a": 0.3, "b": 0.85}, collections.Counter(), 3000
    for _ in range(runs):
        rows = [d | {"place": rng.getrandbits(63), "fraction": chances[d["source"]]} for d in docs]
        batch = pa.RecordBatch.from_pylist(rows, mixing._ARROW)
        out = [r for b in mixing._rounding(mixing._ARROW, True)([batch]) for r in b.to_pylist()]
        assert sorted(r["doc_id"] for r in out) == list(range(30))
        for r in out:
            seen[r["doc_id"]] += r["copies"]
    for d in docs:
        assert seen[d["doc_id"]] / runs == pytest.approx(chances[d["source"]], abs=0.05)


def test_documents_of_a_mix(spark, rows):
    docs = mix_frame(spark, rows * 3, ["a", "b", None])
    mix = mixing.mix_sources(docs)
    want = collections.Counter()
    for r in mix.collect():
        want[r.doc_id, r.source, r["size"]] += r.copies
    out = mixing.repeated(docs, mix)
    assert out.columns == docs.columns
    assert collections.Counter((r.doc_id, r.source, len(words_of(r.text))) for r in out.collect()) == +want


def test_mix_query_keeps_its_contract(spark):
    got = queries.op12_source_mix(spark, "/root/testdata/sf0.001")
    kinds = dict(got.dtypes)
    assert [kinds[c] for c in ("doc_id", "size", "source_size", "target", "taken")] == ["bigint"] * 3 + ["double", "bigint"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for d in docs:
        sizes[d.source] += len(words_of(d.text))
        largest[d.source] = max(largest[d.source], len(words_of(d.text)))
    target = plain_targets(sizes)
    for r in got.collect():
        assert r.taken <= 2 * r["size"] and r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)


# -- fill in the middle -----------------------------------------------------------


def plain_fim(doc_id, text, fim=100, spm=50, seed=7):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(part) for part in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.fixture(scope="module")
def lines(rows):
    rng = random.Random(8)
    parts = ["\n", "a", "é　", "<", "<P", "S>", "<M", ">", "\r\n", "line of text", "\n\n", "<<S"]
    odd = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(200)]
    odd += ["<P>", "a\n<S>b", "x<M>\n", "\n", "\n\n\n", "<P<P\n<S<S\n<M<M\n", "no end", "end\n"]
    return rows + list(enumerate(odd, 5000))


@pytest.mark.parametrize(("fim", "spm"), [(100, 50), (60, 0), (100, 100), (0, 50)])
def test_fill_in_middle(frame, lines, fim, spm):
    got = fill_middle.fill_in_middle(frame(lines), fim_percent=fim, spm_percent=spm).collect()
    want = collections.Counter()
    for doc_id, text in lines:
        n, form, pre, mid, output = plain_fim(doc_id, text, fim, spm)
        want[doc_id, n, form, pre, mid, digest(output), digest(text or ""), output] += 1
    columns = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", "output")
    assert collections.Counter(tuple(r[c] for c in columns) for r in got) == want
    texts = collections.defaultdict(set)
    for doc_id, text in lines:
        texts[doc_id].add((text or "").encode())
    for r in got:
        assert fill_middle.restore(r.output.encode(), r.form).text() in texts[r.doc_id]
        marks, pieces = b"<P><S><M>", [(p.buffer, p.start, p.stop) for p in r.pieces]
        assert any(b"".join((t, marks)[b][i:j] for b, i, j in pieces) == r.output.encode() for t in texts[r.doc_id])


def test_pieces_are_cut_and_put_back():
    text = "ab\ncd\nef".encode()
    table = fill_middle.Table(text)
    table.cut(3)
    table.cut(6)
    assert table.text() == text and [p.stop - p.start for p in table.pieces] == [3, 3, 2]
    assert table.arranged([2, 0, 1]).arranged([1, 2, 0]).text() == text
    assert table.sha256() == hashlib.sha256(text).hexdigest()
    with pytest.raises(ValueError):
        table.cut(99)
    with pytest.raises(ValueError):
        fill_middle.restore(b"<S>x", "psm")
    for form in fill_middle.FORMS:
        assert fill_middle.restore(fill_middle.arrange(text, 3, 6, form).text(), form).text() == text
    assert not np.any([fill_middle.arrange(b"", 0, 0, "plain").pieces[0].stop])


def test_fill_in_middle_of_no_documents(frame):
    assert fill_middle.fill_in_middle(frame([])).count() == 0
