"""Language identification by nearest centroid.

A text is a vector of hashed character bigrams and trigrams of its lower-cased letters, a run of anything
else counting as one blank; weights are sqrt(count) * idf, of unit length. Each language has several
centroids, found by spherical k-means on a bounded sample. The nearest centroid by cosine names the
language; a text farther from it than any training text by a margin is rejected. Short texts have few
n-grams and so lie far from every centroid; their limit is relaxed in proportion.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from farebox.llm.tables import map_batches
from farebox.llm.tokens import portions

BITS = 13
CENTROIDS = 4
# Bounds of the training sample: texts per language, and characters of each.
SAMPLE_TEXTS, SAMPLE_CHARS = 500, 20_000
UNKNOWN = "und"
# A text is rejected below this share of the least similarity a training text has to its centroid.
MARGIN = 0.5
# With fewer n-grams than this the limit falls with the root of their number.
ENOUGH_GRAMS = 400
# Texts that are counted at a time, however short: a row of counts takes 64 KB.
ROWS = 256
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Whether a code point is a letter; made once per process."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(n x 2**BITS counts of hashed n-grams, whether a text has a letter)."""
    lowered = [text.lower() + "\n" for text in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le"), "<u4")
    doc = np.repeat(np.arange(len(texts)), [len(text) for text in lowered])
    letter = _is_letter()[codes]
    # Keep letters and the first character of every other run, as a blank.
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    value, doc, letter = np.where(letter, codes, 32)[kept].astype(np.uint32), doc[kept], letter[kept]
    out = np.zeros(len(texts) << BITS, np.int64)
    pair = value[:-1] * np.uint32(0x9E3779B1) + value[1:] * np.uint32(0x85EBCA77) + np.uint32(0x27D4EB2F)
    triple = pair[:-1] * np.uint32(0xC2B2AE3D) + value[2:] * np.uint32(0x165667B1)
    for gram in (pair, triple):
        n = len(gram)
        inside = doc[:n] == doc[len(doc) - n :]
        mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        slot = (mixed >> np.uint32(32 - BITS)).astype(np.int64) + (doc[:n] << BITS)
        out += np.bincount(slot[inside], minlength=len(out))
    return out.reshape(len(texts), 1 << BITS), np.bincount(doc[letter], minlength=len(texts)) > 0


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


@dataclass
class LanguageModel:
    """Centroids as rows, the language of each, and the similarity below which a text is rejected."""

    idf: np.ndarray
    languages: list[str] = field(default_factory=list)
    centroids: np.ndarray | None = None
    floors: np.ndarray | None = None

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        return _unit(np.sqrt(grams.astype(np.float32)) * self.idf)

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected) of each text."""
        grams, lettered = counts(texts)
        if not self.languages:
            return [(UNKNOWN, 0.0, True)] * len(texts)
        near = self.vectors(grams) @ self.centroids.T
        best = near.argmax(axis=1)
        score = np.clip(near[np.arange(len(texts)), best], 0, 1)
        floor = self.floors[best] * np.sqrt(np.minimum(1, grams.sum(axis=1) / ENOUGH_GRAMS))
        return [
            (self.languages[b], float(s), bool(s < f)) if known else (UNKNOWN, 0.0, True)
            for b, s, f, known in zip(best, score, floor, lettered)
        ]


def _clusters(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means, started from the mean and the rows farthest from those chosen before."""
    centres = _unit(rows.mean(axis=0, keepdims=True))
    while len(centres) < min(k, len(rows)):
        centres = np.vstack([centres, rows[(rows @ centres.T).max(axis=1).argmin()]])
    for _ in range(rounds):
        nearest = (rows @ centres.T).argmax(axis=1)
        centres = _unit(np.vstack([rows[nearest == c].mean(axis=0) for c in np.unique(nearest)]))
    return centres


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """A model from a sample of the labelled rows: the first ``SAMPLE_TEXTS`` of each language by hash of the id.

    A repeated id takes as many places as it has rows; of its texts the one that sorts first is used. What is broadcast is the names of the sample.
    Rows with a null text or label, and texts without a letter, are not used. Without any row the
    model knows no language and rejects everything.
    """
    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"),
        F.xxhash64(F.col(doc_id).cast("string")).alias("h"),
        F.col(doc_id).alias("id"),
        F.substring(text, 1, SAMPLE_CHARS).alias("body"),
    )
    # Only names go to the few tasks that rank a language; the texts of those chosen are fetched afterwards.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    ranked = labelled.select("lang", "h", "id").withColumn("rank", rank).where(f"rank <= {SAMPLE_TEXTS}")
    chosen = ranked.select(F.col("lang").alias("its"), F.col("h").alias("hash"), F.col("id").alias("name")).distinct()
    same = (F.col("lang") == F.col("its")) & (F.col("h") == F.col("hash")) & F.col("id").eqNullSafe(F.col("name"))
    found = labelled.join(F.broadcast(chosen), same, "left_semi")
    sample = found.groupBy("lang", "h", "id").agg(F.min("body").alias("body")).select("lang", "body", "h").collect()
    sample.sort()
    model = LanguageModel(np.ones(1 << BITS, np.float32))
    if not sample:
        return model
    grams = np.vstack([counts(part)[0].astype(np.int32) for _, part in portions([r.body for r in sample], rows=ROWS)])
    some = grams.sum(axis=1) > 0
    model.idf = np.log((1 + some.sum()) / (1 + (grams > 0).sum(axis=0))).astype(np.float32) + 1
    labels = np.array([r.lang for r in sample])[some]
    rows = model.vectors(grams[some])
    centroids, floors = [], []
    for name in np.unique(labels):
        own = rows[labels == name]
        centres = _clusters(own, CENTROIDS)
        near = own @ centres.T
        nearest = near.argmax(axis=1)
        for c, centre in enumerate(centres):
            members = near[nearest == c, c]
            centroids.append(centre)
            floors.append(MARGIN * (members.min() if len(members) else 0))
            model.languages.append(str(name))
    if centroids:
        model.centroids, model.floors = np.vstack(centroids).astype(np.float32), np.array(floors)
    return model


def predict_languages(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, lang_pred, score (the cosine) and rejected.

    A null text and one without a letter is ``und``, score 0, rejected. Whole texts are read, however
    long. Repeated rows are judged alike; an empty table gives an empty result.
    """

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for first, part in portions(texts, 1 << 19, ROWS):
                lang, score, rejected = zip(*model.predict(part))
                columns = [ids.slice(first, len(part)), pa.array(lang), pa.array(score, pa.float64()), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, judge, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows whose language is identified, with all their columns."""
    at = docs.columns.index(text)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in portions(batch.column(at).to_pylist(), 1 << 19, ROWS):
                known = pa.array([not rejected for _, _, rejected in model.predict(part)], pa.bool_())
                yield batch.slice(first, len(part)).filter(known)

    return map_batches(docs, keep, docs.schema)
