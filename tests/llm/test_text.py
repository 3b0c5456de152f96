"""The operators with Python tasks against plain versions, on the small corpus."""

import collections
import hashlib
import json
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from farebox.llm import chat_tools, decontaminate, jaccard_join, language_id, packing, repeats, token_files
from farebox.llm.tokens import Encoder, batch_rows, spaced_words, words

EMPTY = [(5, ""), (5, ""), (None, None), (6, None), (None, "some text here")]


@pytest.fixture(scope="module")
def rows(corpus):
    return corpus + EMPTY + [corpus[0]]


def encode(name, text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("name", "cut"), [("word_bpe_49k.json", words), ("byte_bpe_50k.json", spaced_words)])
def test_pieces_give_the_ids_of_the_text(corpus, name, cut):
    rng = random.Random(3)
    odd = ["".join(rng.choices("aB é\n\t's!.́\xa0　ΣK1\x1c\x01​", k=rng.randint(0, 12))) for _ in range(300)]
    texts = [t or "" for _, t in corpus if len(t or "") < 2000] + odd + ["a\n\nb  c \n d", "<|endoftext|> x", "\nx y\n", " "]
    texts += ["a <|endoftext|> b", "<|startoftext|>", "x<|endoftext|>y. Z,", "<|ENDOFTEXT|>", "Don't stop.' 'S it's. 9.5%, İI ΑΣ, Σ. é.. A\u0301."]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    encoder = Encoder(public_tokenizers.path(name), cut, limit=50)
    got = [np.frombuffer(encoder.encode([t])[0], "<u4").tolist() for t in texts]
    assert got == want and [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want


@pytest.mark.parametrize(("name", "cut"), [("word_bpe_49k.json", words), ("byte_bpe_50k.json", spaced_words)])
def test_punctuation_behind_words_is_learned_apart(name, cut, monkeypatch):
    stems = ["".join(pair) for pair in zip("aeiouyäéßø" * 5, (f"{chr(97 + n % 26)}ord{chr(97 + n // 26)}" for n in range(50)))]
    texts = ["\n".join(" ".join(stem + tail for stem in stems) for tail in (",", ".", "!?", ";", "..."))]
    learned, plain = [], Encoder._learn
    monkeypatch.setattr(Encoder, "_learn", lambda self, new: (learned.extend(new), plain(self, new))[1])
    found = Encoder(public_tokenizers.path(name), cut).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [encode(name, t) for t in texts]
    # The first word of a line stands for itself in the byte-level vocabulary.
    assert len(learned) <= len(stems) + 5 + 5


@pytest.mark.parametrize(("name", "cut"), [("word_bpe_49k.json", words), ("byte_bpe_50k.json", spaced_words)])
def test_batches_give_the_ids_of_their_texts(name, cut):
    rng = random.Random(5)
    parts = ["été", "Ωmega", "ΑΣ", "don't", "x1", "ÄÖ", "Word", "ªµº", "H\u0331", "A\u0301", "œuf", "3", "'s", "###", "", "­", "a.b"]
    tails = ["", "", "", ",", ".", "!?", "'", ".'", "…", "»", "),"]
    texts = []
    for _ in range(400):
        space = rng.choice([" ", " ", " ", "\n", "  ", "\t", "\x0b"])
        some = [rng.choice(parts) + rng.choice(tails) for _ in range(rng.randint(0, 30))]
        texts.append("".join(w + rng.choice([" ", " ", space]) for w in some))
    texts += ["<|endoftext|>", "", "\x01a, b", "a\x1cb."]
    want = [np.array(encode(name, t), "<u4").tobytes() for t in texts]
    whole = Encoder(public_tokenizers.path(name), cut)
    assert whole.encode(texts) == want and whole.encode(texts[::-1]) == want[::-1] and whole.encode([]) == []
    few = Encoder(public_tokenizers.path(name), cut, limit=30)
    for at in [*range(0, len(texts), 7)] * 2:
        assert few.encode(texts[at : at + 7]) == want[at : at + 7]


def test_rows_are_taken_from_batches_by_their_bytes():
    texts = ["abc", None, "é" * 9, "", *["x"] * 900, "y" * 50, "z"]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    got = list(batch_rows(batch, 40))
    assert [i for ids, _ in got for i in ids] == list(range(len(texts)))
    assert [t for _, some in got for t in some] == [t or "" for t in texts]
    assert all(len(some) == 1 or sum(len(t.encode()) for t in some) <= 40 for _, some in got)
    assert list(batch_rows(batch.slice(0, 0))) == []


def test_packing(frame, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack_documents(frame(rows), path, capacity=128, places=16, window=50).collect()
    pieces, used = collections.Counter(), collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.piece, r.start, bytes(r.ids)] += 1
        assert (r.length, r.ids_crc32) == (len(r.ids) // 4, zlib.crc32(r.ids))
        used[r.sequence_id].append((r.offset, r.length))
    want = collections.Counter()
    for doc_id, text in rows:
        ids = [*encode("word_bpe_49k.json", text), 1]
        for k, at in enumerate(range(0, len(ids), 128)):
            want[doc_id, k, at, np.array(ids[at : at + 128], "<u4").tobytes()] += 1
    assert pieces == want
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    assert packing.pack_documents(frame([]), path).count() == 0


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    bins = packing.OpenSequences(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    assert [bins.place(n) for n in (5, 8, 7, 5)] == [(2, 0), (3, 0), (4, 0), (2, 5)]


def test_token_files(spark, frame, rows, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_files(frame(rows), str(tmp_path / "f"), path)
    got = sorted(token_files.read_token_files(spark, str(tmp_path / "f")).collect(), key=lambda r: r.start)
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert ids == sorted(ids) and len(got) == len(rows)
    at = 0
    for r in got:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens and zlib.crc32(r.ids) == r.ids_crc32
        at += r.n_tokens
    want = collections.Counter((i, np.array([*encode("byte_bpe_50k.json", t), 0], "<u4").tobytes()) for i, t in rows)
    assert collections.Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    some = token_files.read_some(spark, str(tmp_path / "f"), [12, 40]).collect()
    assert {(r.doc_id, r.start) for r in some} == {(r.doc_id, r.start) for r in got if r.doc_id in (12, 40)}
    token_files.write_token_files(frame([]), str(tmp_path / "e"), path)
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_token_files_with_many_null_ids(spark, frame, tmp_path, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = frame([(None, f"no id {n}") for n in range(1500)] + [(7, "copy")] * 1500 + [(12, "some text")]).coalesce(1)
    sampled, plain = [], token_files.map_batches

    def counting(df, function, schema):
        if schema == "ids binary":
            sampled.append(df.count())
        return plain(df, function, schema)

    monkeypatch.setattr(token_files, "map_batches", counting)
    token_files.write_token_files(docs, str(tmp_path / "f"), path)
    assert sampled and sampled[0] <= token_files.SAMPLE_DOCS
    few = [(None, "no id"), (12, "some text")]
    token_files.write_token_files(frame(few).coalesce(1), str(tmp_path / "g"), path)
    assert [r.doc_id for r in token_files.read_some(spark, str(tmp_path / "g"), [12]).collect()] == [12]


def _components(rows):
    """(id, shingles, component) of every row, the component as a number, by comparing all pairs."""
    sets = []
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append((doc_id, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    label = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    return [(doc_id, len(s), k) for k, (doc_id, s) in zip(label, sets)]


def _named(rows):
    """What the operator returns."""
    found, least = _components(rows), {}
    for doc_id, _, k in found:
        if doc_id is not None:
            least[k] = min(doc_id, least.get(k, doc_id))
    return [(d, n, least.get(k) if n else d) for d, n, k in found]


@pytest.mark.parametrize(("block", "long"), [(4_000_000, 64), (300, 3)])
def test_jaccard_classes(frame, rows, monkeypatch, block, long):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    got = jaccard_join.similar_classes(frame(rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _named(rows)))


@pytest.fixture(scope="module")
def chains():
    """Chains of texts of which only neighbours are similar, some of them with no id or with one id for all."""
    rng = random.Random(13)
    word = lambda: f"w{rng.randrange(10**6)}"
    rows = []
    for ids in ([1, None, 2], [None, 5, None, 4], [None, None, None], [7, 7, 7, 6], [9, 9, None, 8]):
        words = [word() for _ in range(60)]
        for doc_id in ids:
            rows.append((doc_id, " ".join(words)))
            words = words[4:] + [word() for _ in range(4)]
    return rows + [(7, "a text of its own with an id that others have"), (None, ""), (7, None), rows[0], rows[1], rows[1]]


@pytest.mark.parametrize("block", [4_000_000, 150])
def test_links_run_through_rows_without_an_id(frame, chains, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    got = jaccard_join.similar_classes(frame(chains)).collect()
    want = _named(chains)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert (2, 56, 1) in want and (8, 56, 8) in want


def test_rows_of_one_id_are_not_multiplied(frame, monkeypatch):
    rng = random.Random(17)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(300)]
    rows = [(1, t) for t in texts] + [(1, t + " and more") for t in texts] + [(2, texts[0])] * 400
    sent, plain = [], jaccard_join.map_batches

    def counting(df, function, schema):
        if schema == "cls long, label long":
            sent.append(df.count())
        return plain(df, function, schema)

    monkeypatch.setattr(jaccard_join, "map_batches", counting)
    got = jaccard_join.similar_classes(frame(rows)).collect()
    assert len(got) == len(rows) and {r.component_id for r in got} == {1}
    assert sum(sent) < 700


def test_one_row_of_each_group_stays(frame, rows, chains):
    data = rows + [(d if d is None else d + 1000, t) for d, t in chains]
    docs = frame(data).withColumns({"key": F.lit(1), "row": F.lit("r"), "stays": F.lit("s"), "maybe": F.col("doc_id")})
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    groups, want = collections.defaultdict(set), collections.Counter()
    for (doc_id, text), (_, n, k) in zip(data, _components(data)):
        if n:
            groups[k].add((doc_id, text))
        else:
            want[doc_id, text] += 1
    for group in groups.values():
        (found,) = [row for row in group if got[row]]
        assert got[found] == 1 and found[0] == min((d for d, _ in group if d is not None), default=None)
        want[found] += 1
    assert got == want
    assert jaccard_join.one_of_each(frame([])).count() == 0


def _template_sets(n):
    """Sets that share a template, most pairs of them just below the similarity and a few above it."""
    rng = np.random.default_rng(2)
    template = rng.integers(1, 1 << 62, 90, dtype=np.uint64)
    sets = [np.unique(np.concatenate([template, rng.integers(1, 1 << 62, rng.integers(9, 26), dtype=np.uint64)])) for _ in range(n)]
    return sets + [np.append(sets[0], np.uint64(1 << 63)), sets[1][:-2]]


def _linked(sets, compared=lambda i, j: True):
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            shared = len(np.intersect1d(a, b))
            if compared(i, j) and 5 * shared >= 4 * (len(a) + len(b) - shared):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def test_links_of_many_candidates_and_between_sides():
    sets = _template_sets(150)
    assert jaccard_join.link_sets(sets).tolist() == _linked(sets)
    side = np.arange(len(sets)) % 2
    assert jaccard_join.link_sets(sets, side, np.arange(len(sets))).tolist() == _linked(sets, lambda i, j: side[i] != side[j])
    assert set(jaccard_join.link_sets(sets, side, np.zeros(len(sets), int))) == {0}


def test_open_lists_across_a_cut_are_no_pairs(frame, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 3000)
    compared, plain = [], jaccard_join.map_batches

    def counting(df, function, schema):
        if schema == "a long, b long":
            compared.append(df.count())
        return plain(df, function, schema)

    monkeypatch.setattr(jaccard_join, "map_batches", counting)
    rng = random.Random(4)
    own = lambda k: [f"w{rng.random()}" for _ in range(k)]
    template = own(88)
    texts = [" ".join(template + own(rng.randint(9, 26))) for _ in range(200)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    label = list(range(200))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b) and label[i] != label[j]:
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_classes(frame([*enumerate(texts)])).collect()}
    assert got == dict(enumerate(label))
    assert sum(compared) < 20 * len(texts)


def test_the_sketch_grows_with_the_input():
    assert [jaccard_join.sketch_bits(n) for n in (1, 32, 33, 64, 200, 10**6)] == [18, 18, 19, 19, 21, 22]


def test_jaccard_of_nothing(frame):
    assert jaccard_join.similar_classes(frame([])).count() == 0


def test_repeated_bytes(frame, rows):
    bodies = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[i : i + 200] for b in bodies for i in range(len(b) - 199))
    want = []
    for (doc_id, _), b in zip(rows, bodies):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        want.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest())
           for r in repeats.remove_repeats(frame(rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert repeats.remove_repeats(frame([])).count() == 0


def _shared_passage(n, size):
    """Texts that share a passage of ``size`` bytes between surroundings of their own, some of them copies."""
    rng = random.Random(11)
    own = lambda k: "".join(rng.choices("abcdefghij ", k=k))
    passage = own(size)
    texts = [own(rng.randint(60, 140)) + passage + own(rng.randint(60, 140)) for _ in range(n)]
    return [*enumerate(texts), *enumerate(texts[:20], n), (0, texts[0])]


def _covered(bodies):
    seen = collections.Counter(b[i : i + 200] for b in bodies for i in range(len(b) - 199))
    gone = [[any(seen[b[i : i + 200]] > 1 for i in range(max(0, at - 199), min(at, len(b) - 200) + 1)) for at in range(len(b))]
            for b in bodies]
    return [bytes(x for x, g in zip(b, flags) if not g) for b, flags in zip(bodies, gone)]


@pytest.mark.parametrize("size", [150, 199, 230])
def test_repeated_bytes_of_a_crowded_anchor(frame, size):
    # One task has a crowd of runs for the anchor, another has not; both have runs that are equal.
    rows = _shared_passage(400, size)
    docs = frame(rows[:330]).coalesce(1).union(frame(rows[330:]).coalesce(4))
    want = [(d, kept) for (d, _), kept in zip(rows, _covered([t.encode() for _, t in rows]))]
    got = [(r.doc_id, bytes(r.kept)) for r in repeats.remove_repeats(docs).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize(("crowd", "group"), [(256, 4096), (10**9, 100)])
def test_runs_of_a_crowded_anchor_do_not_meet(monkeypatch, crowd, group):
    monkeypatch.setattr(repeats, "CROWD", crowd, raising=False)
    monkeypatch.setattr(repeats, "GROUP", group, raising=False)
    texts = [t.encode() for _, t in _shared_passage(600, 150)[:600]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(600), pa.int64()), pa.array(texts)], names=["row", "text"])
    settled = pa.Table.from_batches([b for x in repeats._scan(8)([batch]) for b in repeats._settle([x])])
    asked = collections.defaultdict(list)
    for x in settled.to_pylist():
        if x["anchor"] is not None:
            asked[x["row"]].append(x)
    assert len(asked) > 400
    columns = [pa.array(list(asked)), pa.array([texts[r] for r in asked]), pa.array(list(asked.values()))]
    cut = [b for b in repeats._cut(8)([pa.RecordBatch.from_arrays(columns, names=["row", "text", "asked"])])]
    sizes = collections.Counter()
    for x in pa.Table.from_batches(cut).to_pylist():
        sizes[x["bucket"]] += len(x["body"] or x.get("windows") or b"")
    assert max(sizes.values()) < 0.1 * sum(sizes.values())


def _edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_leaks(spark, frame):
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefghij ", k=n)).strip() for n in (100, 180, 400, 20)]
    benchmark = spark.createDataFrame([*enumerate(texts), (9, None), (8, "")], "item_id long, text string")
    docs = [(0, "x y " + texts[0].upper() + "\n z"), (1, "clean text only " * 9), (2, None), (3, "")]
    docs += [(4, texts[2][80:330]), (5, texts[3]), (None, texts[1])]
    for k, edits in enumerate((2, 5, 9, 14, 30)):
        body = list(texts[1])
        for at in rng.sample(range(len(body)), edits):
            body[at] = rng.choice(["", "#", "##"])
        docs.append((10 + k, "before the item " + "".join(body) + " and after"))
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(frame(docs), benchmark).collect()}
    want = set()
    for doc_id, text in docs:
        for item, body in enumerate(texts):
            for _, probe in decontaminate.probes_of(decontaminate.normalised(body)):
                if _edits(probe, decontaminate.normalised(text or "")) <= len(probe) // decontaminate.BYTES_PER_EDIT:
                    want.add((doc_id, item))
    assert set(got) == want and {(0, 0), (4, 2), (10, 1), (None, 1)} <= want
    assert got[0, 0].distance == 0
    kept = decontaminate.drop_leaks(frame(docs), benchmark)
    assert kept.columns == frame(docs).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in {w[0] for w in want})
    assert decontaminate.find_leaks(frame([]), benchmark).count() == 0
    assert decontaminate.find_leaks(frame(docs), benchmark.limit(0)).count() == 0


def test_excerpts_from_the_middle_of_items():
    rng = random.Random(6)
    items = ["".join(rng.choices("abcdefghij ", k=n)).strip("  ").replace("  ", " b") for n in (82, 95, 118, 160, 240, 394, 900)]
    index = decontaminate.Index.build([(no, item.encode()) for no, item in enumerate(items)])
    texts, want = ["nothing of them " * 20], set()
    for no, item in enumerate(items):
        for percent in (50, 70, 80, 88):
            size = -(-len(item) * percent // 100)
            for at in ((len(item) - size) // 2, (len(item) - size) // 3):
                want.add((len(texts), no))
                texts.append("Other words " + item[at : at + size] + " and more of them")
    assert {hit[:2] for hit in index.search(texts)} == want
    for n in range(decontaminate.SHORTEST, 500):
        for _, probe in decontaminate.probes_of(bytes(n)):
            edits = len(probe) // decontaminate.BYTES_PER_EDIT
            assert len(probe) - decontaminate.Q + 1 - edits * decontaminate.Q >= 1


def _leaks_of(index, texts):
    """(text number, probe) pairs whose probe is in the text, by plain edit distance, and the edits."""
    found = {}
    for no, text in enumerate(texts):
        body = decontaminate.normalised(text)
        for probe in index.probes:
            if len(probe) < decontaminate.SHORTEST:
                edits = 0 if b" " + probe + b" " in b" " + body + b" " else 1
                allowed = 0
            else:
                edits, allowed = _edits(probe, body), len(probe) // decontaminate.BYTES_PER_EDIT
            if edits <= allowed:
                found[no, probe] = edits
    return found


@pytest.mark.parametrize("expanded", [1 << 21, 40])
def test_probes_against_plain_edit_distance(monkeypatch, expanded):
    monkeypatch.setattr(decontaminate, "EXPANDED", expanded)
    monkeypatch.setattr(decontaminate, "ALIGNED", 3)
    rng = random.Random(8)
    template = "Answer the question with one of the words given below: "
    items = [template + "".join(rng.choices("abcdefgh ", k=rng.randint(1, 90))) for _ in range(4)]
    items += ["seven", "two words", "é à", "a" * 40, "".join(rng.choices("abcd ", k=230))]
    texts = [template * 2, "seventh heaven", "the seven, or seven", "seven", "x two\n WORDS", "twotwo words.", "É  à", "a" * 60, "", " "]
    for item in items[:4] + items[-1:]:
        for _ in range(3):
            body = list(item)
            for at in rng.sample(range(len(body)), rng.randint(0, len(body) // 12)):
                body[at] = rng.choice(["", "#", "ab", "a"])
            begin, end = rng.choice([(0, len(body)), (len(body) // 4, len(body)), (0, 3 * len(body) // 4)])
            texts.append(rng.choice(["", "before "]) + "".join(body[begin:end]) + rng.choice(["", " after"]))
    index = decontaminate.Index.of([(probe, probe) for probe in dict.fromkeys(
        p for item in items for _, p in decontaminate.probes_of(decontaminate.normalised(item)))])
    want = _leaks_of(index, texts)
    assert {(no, probe): edits for no, probe, _, edits, _ in index.search(texts)} == want
    assert {(2, b"seven"), (3, b"seven"), (4, b"two words"), (6, "é à".encode())} <= set(want)
    assert not {(1, b"seven"), (5, b"two words")} & set(want)


def test_items_that_share_passages_are_one_class(spark, frame):
    rng = random.Random(9)
    template = "Read the passage below and then say in one word what it is about, please, and why it may be so: "
    assert len(template) == 96  # so the probes that reach into what is an item's own hold much of that
    own = ["".join(rng.choices("abcdefghijklm ", k=140)) for _ in range(30)]
    items = [(i, template + o) for i, o in enumerate(own)] + [(40, own[7] + " " + own[8]), (None, own[5]), (2, template + own[2])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = [(100 + i, "some words before " + template + " and others " * 5) for i in range(20)] + [(1, own[7]), (2, "nothing")]
    found = decontaminate.find_leaks(frame(docs), benchmark).collect()
    members = collections.defaultdict(set)
    for r in decontaminate.class_items(benchmark).collect():
        members[r.holders, r.n_items].add(r.item_id)
    by_doc = collections.defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        assert len(members[r.holders, r.n_items]) == r.n_items and r.item_id == min(x for x in members[r.holders, r.n_items] if x is not None)
    assert set(by_doc) == {*range(100, 120), 1}
    # The template is one row per document, not one for each item.
    for doc in range(100, 120):
        (row,) = by_doc[doc]
        assert members[row.holders, row.n_items] == set(range(30))
    assert set().union(*(members[r.holders, r.n_items] for r in by_doc[1])) == {7, 40}


def test_language(spark, frame):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.fit(docs.where("doc_id % 4 <> 2"))
    held = docs.where("doc_id % 4 = 2")
    found = {r.doc_id: r for r in language_id.predict_languages(held, model).collect()}
    rows = held.select("doc_id", "lang").collect()
    assert sum(found[r.doc_id].lang_pred == r.lang for r in rows) >= 0.95 * len(rows)
    odd = frame([(1, None), (2, ""), (3, "123 ?!"), (None, "the and of"), (5, "Привет как дела сегодня у нас " * 30)])
    got = {r.doc_id: r for r in language_id.predict_languages(odd, model).collect()}
    assert all((got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True) for i in (1, 2, 3))
    assert got[5].rejected and not got[None].rejected
    assert [r.doc_id for r in language_id.keep_identified(odd, model).collect()] == [None]
    assert language_id.predict_languages(frame([]), language_id.fit(frame([]))).count() == 0


def test_the_sample_of_languages_does_not_depend_on_order(frame, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_TEXTS", 3)
    rows = [(k, f"the words of number {k}") for k in range(20)] + [(None, f"no id {k}") for k in range(30)]
    rows += [(5, f"again {k}") for k in range(50)] + [(7, None), (8, "")]
    fits = [language_id.fit(frame(some)) for some in (rows, rows[::-1])]
    assert np.array_equal(fits[0].idf, fits[1].idf) and np.array_equal(fits[0].centroids, fits[1].centroids)
    assert fits[0].languages and set(fits[0].languages) == {"en"}


SCHEMA = {"f": {"type": "object", "properties": {"n": {"type": "integer", "minimum": 1}, "s": {"enum": ["a"]}},
                "required": ["n"], "additionalProperties": False}}


def plain_levels(calls):
    """Levels by following what each call names, None in or behind a cycle."""
    known = {}
    for conv, call, after in calls:
        known.setdefault((conv, call), [(conv, a) for a in after or []])
    levels = {}

    def level(key, path):
        if key in path:
            return None
        if key not in levels:
            before = [level(k, path | {key}) for k in known[key] if k in known]
            levels[key] = None if None in before else 1 + max(before, default=-1)
        return levels[key]

    return {key: level(key, frozenset()) for key in known}


def frames_of(spark, calls, results):
    c = spark.createDataFrame(calls, "conv_id long, call_id string, turn long, name string, arguments string, after array<string>")
    return c, spark.createDataFrame(results, "conv_id long, call_id string, turn long, content string")


def test_tool_calls(spark):
    calls = [(1, "a", 0, "f", '{"n": 2}', []), (1, "b", 2, "f", '{"s": "b", "z": [1]}', ["a", "gone"]),
             (1, "c", 4, "f", "{", ["b", "a"]), (1, "d", 6, "g", "{}", ["e"]), (1, "e", 8, "f", None, ["d"]),
             (2, None, 0, "f", "{}", []), (1, "a", 0, "f", '{"n": 2}', []), (2, "x", 1, "f", '{"n":true}', None),
             (2, "a", 5, "f", '{"n": 9}', ["x"]), (1, "a", 3, "f", '{"n": 4}', []), (None, "a", 1, "f", '{"n": 1}', [])]
    results = [(1, "a", 1, "é\n"), (1, "c", 5, "late"), (1, "c", 6, "later"), (3, "lost", 7, "r"), (3, None, 8, "q"), (2, "a", 6, "two")]
    c, r = frames_of(spark, calls, results)
    rows = chat_tools.link_calls(c, r, SCHEMA).collect()
    status = collections.Counter((x.conv_id, x.call_id, x.turn, x.status, x.level) for x in rows)
    assert status == collections.Counter([
        (1, "a", 0, "linked", 0), (1, "b", 2, "unanswered", 1), (1, "c", 4, "linked", 2), (1, "d", 6, "cycle", None),
        (1, "e", 8, "cycle", None), (2, None, 0, "nameless", None), (2, "x", 1, "unanswered", 0), (2, "a", 5, "linked", 1),
        (1, "a", 3, "surplus", None), (None, "a", 1, "unanswered", 0), (1, "c", 6, "surplus", None),
        (3, "lost", 7, "orphan", None), (3, None, 8, "orphan", None)])
    got = {(x.conv_id, x.call_id): x for x in rows if x.status not in ("surplus", "nameless")}
    assert got[1, "a"].valid and got[1, "a"].line == '{"arguments":{"n":2},"id":"a","name":"f","result":"é\\n"}'
    assert json.loads(got[2, "a"].line)["result"] == "two"
    assert got[1, "b"].errors == "$.n: missing; $.s: not one of the allowed values; $.z: unknown"
    assert got[1, "c"].errors == "$: not JSON" and json.loads(got[1, "c"].line)["result"] == "late"
    assert got[2, "x"].errors == "$.n: not of type integer" and got[1, "d"].errors == "$: unknown tool"
    assert chat_tools.link_calls(c.limit(0), r.limit(0), SCHEMA).count() == 0


def test_levels_of_long_chains_and_of_graphs(spark, monkeypatch):
    """A chain of 300 calls takes few rounds; random graphs with cycles get the levels of a plain search."""
    rng = random.Random(21)
    calls = [(1, f"k{n}", n, "f", "{}", [f"k{n - 1}"] if n else []) for n in range(300)]
    for conv in (2, 3):
        for n in range(25):
            before = [f"k{rng.randrange(n)}" for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))] if n else []
            if n in (17, 18) and conv == 3:
                before.append(f"k{35 - n}")
            calls.append((conv, f"k{n}", n, "f", "{}", before))
    staged, plain = [], chat_tools.stage
    monkeypatch.setattr(chat_tools, "stage", lambda df, label: (staged.append(label), plain(df, label))[1])
    c, r = frames_of(spark, calls, [])
    got = {(x.conv_id, x.call_id): x.level for x in chat_tools.link_calls(c, r, SCHEMA).collect()}
    assert got == plain_levels([(x[0], x[1], x[5]) for x in calls])
    assert got[1, "k299"] == 299 and staged.count("levels") < 30
    assert any(level is None for level in got.values())


def test_pipeline(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    more = source.limit(3).unionByName(source.limit(1).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars"))
    docs = source.unionByName(more).withColumn("spans", F.lit(1))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    before = frame.count()
    for name, function in corpus_pipeline.STAGES:
        after = function(spark, frame, str(tmp_path))
        if name != "best-fit packing":
            assert after.columns == frame.columns
        path = str(tmp_path / name.replace(" ", "_"))
        after.write.parquet(path)
        frame = spark.read.parquet(path)
        ids = [r.doc_id for r in frame.select("doc_id").collect()]
        if name == "n-gram Jaccard join":
            assert len(ids) == len(set(ids)) < before
    assert sum(r.length for r in frame.select("length").collect()) > 0
