"""The whole pipeline against a plain version of its five stages, row by row."""

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_native import SECRETS, _spans
from test_text import _components, _edits
from tokenizers import Tokenizer

import corpus_pipeline
from farebox.llm import decontaminate, language_id, queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "__word", "row"]


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    """A small corpus with copies, near copies, leaks, secrets, odd texts, repeated and null ids, clashing names."""
    rng = random.Random(12)
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source").sort("doc_id").limit(50)
    rows = [(r.doc_id, " ".join(r.text.split()[:70]), r.lang, r.source) for r in source.collect()]
    items = [(0, "Which of the three rivers named above runs into the northern sea, and why is it never frozen there?"),
             (1, " ".join(rng.choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=14))), (2, "exactly these words"), (3, None)]
    near = rows[3][1].split()
    near[5] = "changed"
    texts = [rows[4][1], " ".join(near), items[0][1].upper().replace(" ", "\n"), "and " + rows[6][1] + " " + items[0][1][20:95],
             rows[7][1] + " exactly  THESE words " + rows[8][1], rows[9][1] + " exactly these wordsmiths", "", None, " \n", "12 34", None, "", "the of"]
    texts += [rows[10 + k][1] + " " + secret + " " + rows[11 + k][1] for k, secret in enumerate(SECRETS)]
    rows += [(1000 + k, text, "en", None) for k, text in enumerate(texts)]
    rows += [rows[0], rows[0], (None, rows[20][1] + " one with no id", None, "s"), (rows[21][0], rows[22][1] + " repeated id " + rows[23][1], "de", "s")]
    rows = [(*row, None if row[1] is None else len(row[1]), k, "r") for k, row in enumerate(rows)]
    path = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long, __word int, row string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def plain_languages(model, rows):
    """Nearest centroid of sparse vectors, one text at a time."""
    kept = []
    for row in rows:
        text = "".join(c if c.isalpha() else " " for c in (row[1] or "").lower() + "\n")
        codes = [ord(c) for c in re.sub(" +", " ", text).lstrip(" ")]
        if not any(chr(c).isalpha() for c in codes):
            continue
        grams = collections.Counter()
        for i in range(len(codes) - 1):
            pair = (codes[i] * 0x9E3779B1 + codes[i + 1] * 0x85EBCA77 + 0x27D4EB2F) % 2**32
            found = [pair]
            if i + 2 < len(codes):
                found.append((pair * 0xC2B2AE3D + codes[i + 2] * 0x165667B1) % 2**32)
            for gram in found:
                grams[((gram ^ gram >> 15) * 0x2C1B3C6D) % 2**32 >> 32 - language_id.BITS] += 1
        weight = {slot: math.sqrt(n) * float(model.idf[slot]) for slot, n in grams.items()}
        length = math.sqrt(sum(w * w for w in weight.values()))
        near = [sum(w * float(c[slot]) for slot, w in weight.items()) / length for c in model.centroids]
        best = max(range(len(near)), key=near.__getitem__)
        if near[best] >= float(model.floors[best]) * math.sqrt(min(1, grams.total() / language_id.ENOUGH_GRAMS)):
            kept.append(row)
    return kept


def plain_distinct(rows):
    """The row with the least id of each group; the first of rows that are alike."""
    groups, kept = collections.defaultdict(list), []
    for row, (_, n, group) in zip(rows, _components([row[:2] for row in rows])):
        if n:
            groups[group].append(row)
        else:
            kept.append(row)
    return kept + [min(group, key=lambda row: (row[0] is None, row[0])) for group in groups.values()]


def plain_clean(rows, items):
    """Rows that hold no probe of an item."""
    kept = []
    for row in rows:
        body = decontaminate.normalised(row[1] or "")
        held = False
        for _, item in items:
            for _, probe in decontaminate.probes_of(decontaminate.normalised(item or "")):
                if len(probe) < decontaminate.SHORTEST:
                    held |= b" " + probe + b" " in b" " + body + b" "
                else:
                    held = held or _edits(probe, body) <= len(probe) // decontaminate.BYTES_PER_EDIT
        if not held:
            kept.append(row)
    return kept


def plain_redacted(rows):
    out = []
    for row in rows:
        text, at, done = row[1], 0, ""
        spans = _spans(text or "")
        for begin, _, until in spans:
            if begin >= at:
                done += text[at:begin] + "[SECRET]"
            at = max(at, until)
        if spans:
            row = (row[0], done + text[at:], row[2], row[3], len(done + text[at:]), *row[5:])
        out.append(row)
    return out


def plain_pieces(rows, capacity=4096):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for row in rows:
        ids = [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4").tobytes()
            out.append((row[0], piece, at, len(part) // 4, zlib.crc32(part)))
    return out


def _alike(got, want):
    """Rows as a multiset; of rows that are alike but for their number any one may stay."""
    def shown(row):
        return tuple(map(repr, (*row[:5], row[6])))
    found, asked = collections.Counter(map(shown, got)), collections.Counter(map(shown, want))
    assert (found - asked, asked - found) == (collections.Counter(), collections.Counter())


def test_pipeline_against_a_plain_version(spark, fixture, tmp_path):
    path, rows, items = fixture
    model = queries.learned_languages(spark.read.parquet(f"{path}/documents.parquet"))
    plain = [
        lambda rows: plain_languages(model, rows),
        plain_distinct,
        lambda rows: plain_clean(rows, items),
        plain_redacted,
    ]
    frame, kept = spark.read.parquet(f"{path}/documents.parquet"), [len(rows)]
    for (name, function), version in zip(corpus_pipeline.STAGES, plain):
        after = function(spark, frame, path)
        assert after.columns == COLUMNS
        after.write.parquet(str(tmp_path / name.replace(" ", "_")))
        frame = spark.read.parquet(str(tmp_path / name.replace(" ", "_")))
        rows = version(rows)
        _alike(frame.collect(), rows)
        kept.append(len(rows))
    # Every stage has something to do.
    assert kept[0] > kept[1] > kept[2] > kept[3] == kept[4]
    assert sum("[SECRET]" in row[1] for row in rows) >= 5
    final = corpus_pipeline.run(spark, path).collect()
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in final]
    assert collections.Counter(got) == collections.Counter(plain_pieces(rows))
    places = collections.defaultdict(list)
    for r in final:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    tasks = spark.read.parquet(f"{path}/documents.parquet").select(F.spark_partition_id()).distinct().count()
    assert len(places) <= -(-sum(r.length for r in final) // 4096) + max(tasks, 8)
