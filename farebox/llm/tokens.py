"""Ids of whole texts by a tokenizer file, a distinct piece of text being encoded once.

Both vocabularies in use never merge across the start of a run of white space, so a text can be cut
there and its ids are those of the pieces, one after the other. Texts with unusual white space or
control characters, for which libraries disagree on what white space is, are encoded in one go.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Characters for which definitions of white space differ, or that are no plain separators.
_ODD = re.compile(r"[\x85\xa0 ᠎ -‏ -  -⁯　﻿]")
_RUNS = re.compile(r"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
_TWO = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\x0b", "\x0c")


# Before a piece that stands for itself, where pieces otherwise stand for a blank and themselves.
_AS_IS = "\x01"


def _odd(text: str) -> bool:
    return not text.isascii() and _ODD.search(text) is not None or any(c in text for c in "\x01\x1c\x1d\x1e\x1f")


def words(text: str) -> list[str]:
    """Pieces for vocabularies that drop white space."""
    return [_AS_IS + text] if _odd(text) else text.split()


def spaced_words(text: str) -> list[str]:
    """Pieces for byte-level vocabularies, where a word keeps the white space before it.

    A piece stands for a blank and itself; one that begins with a line end or with the mark for itself.
    """
    if _odd(text):
        return [_AS_IS + text]
    if any(two in text for two in _TWO):
        return [_AS_IS + piece for piece in _RUNS.findall(text)]
    pieces = text.replace("\n", " \n").split(" ")
    pieces[0] = _AS_IS + pieces[0]
    return pieces


# Behind a letter or a digit a run of these is a token of its own in both vocabularies. The apostrophe is not: it may begin "'s".
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_TAILS = frozenset(_TAIL)
# Lower case of what lies beyond may depend on the version of Unicode or on the letters around, as may what a letter is.
_BEYOND = re.compile("[\u0100-\U0010ffff]")


def _split_tail(piece: str) -> tuple[str, str | None]:
    """A word and the punctuation behind it, if their ids do not depend on each other."""
    stem = piece.rstrip(_TAIL)
    if stem[-1:].isalpha() or stem[-1:] in "0123456789" and stem:
        return stem, _AS_IS + piece[len(stem) :]
    return piece, None


# Pieces put together at a time.
_JOINED = 1 << 16


# A word's end and the punctuation behind it, up to white space; letters are those of Latin-1. `_split_tail` does it for others.
_ENDED = r"([0-9A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}])([!-&(-/:-@\[-`{-~]+)([ \t\n\r\x0b\x0c]|$)"

_APART = rf"\1 {_AS_IS}\2\3"


def _latin(text: str) -> bool:
    """Whether a text has nothing beyond Latin-1, so that its lower case is the same everywhere."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Store:
    """Runs of ids end to end, by number."""

    def __init__(self):
        self.size, self._used = 0, 0
        self._ids, self._start, self._count = np.empty(1 << 12, "<u4"), np.empty(1 << 10, np.int64), np.empty(1 << 10, np.int64)
        # Runs that were asked for again after they had been learned.
        self.again = np.zeros(1 << 10, bool)

    def add(self, ids: np.ndarray, counts: np.ndarray) -> int:
        """Take up runs of ``counts`` ids; the number of the first."""
        first, size, used = self.size, self.size + len(counts), self._used + len(ids)
        if size > len(self._start):
            more = size + size // 2
            self._start, self._count = np.resize(self._start, more), np.resize(self._count, more)
            self.again = np.concatenate([self.again, np.zeros(more - len(self.again), bool)])
        if used > len(self._ids):
            self._ids = np.resize(self._ids, used + used // 2)
        self._ids[self._used : used] = ids
        self._count[first:size] = counts
        self._start[first:size] = self._used + np.cumsum(counts) - counts
        self.size, self._used = size, used
        return first

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        return self._count[numbers]

    def join(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of these runs, one after the other."""
        out = np.empty(self._count[numbers].sum(), "<u4")
        done = 0
        for at in range(0, len(numbers), _JOINED):
            some = numbers[at : at + _JOINED]
            counts = self._count[some]
            ends = np.cumsum(counts)
            n = int(ends[-1])
            out[done : done + n] = self._ids[np.repeat(self._start[some] - ends + counts, counts) + np.arange(n)]
            done += n
        return out


class Encoder:
    """Encodes texts to the bytes of their ids as little-endian unsigned 32-bit integers.

    Arrow splits texts and finds the distinct words of some texts at a time, so Python sees each of these once.
    Words are remembered without the punctuation behind them, and in lower case where the vocabulary
    has no other. Up to ``limit`` of them are; then those that were needed only once go. A text that
    holds a token added to the vocabulary, such as its end mark, is encoded as the library does it, in one go.
    """

    def __init__(self, path: str, cut: Callable[[str], list[str]], limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._cut, self._limit = cut, limit
        self._known: dict[str, int] = {}
        self._store = _Store()
        # Dropped white space separates pieces; kept white space begins them.
        self._spaced = cut is spaced_words
        added = self._tokenizer.get_added_tokens_decoder()
        self._added = [token.content for token in added.values()]
        # A token that is looked for before anything else keeps what stands around it apart.
        marks = [k for k, token in added.items() if token.special and not (token.normalized or token.lstrip or token.rstrip)]
        self._mark = min(marks, default=None)
        vocabulary = self._tokenizer.get_vocab()
        # Ids that begin a word of letters after a blank, or that end one.
        self._edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self._edge[[k for t, k in vocabulary.items() if (t[0] == "\u0120" if self._spaced else t.endswith("</w>"))]] = True
        self._lower = not self._spaced and self._by_library(["A"])[0] == self._by_library(["a"])[0]

    def _text(self, piece: str) -> str:
        if piece[:1] == _AS_IS:
            return piece[1:]
        return " " + piece if self._spaced and piece[:1] != "\n" else piece

    def _fast(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _by_library(self, pieces: list[str]) -> list[np.ndarray]:
        """The ids of each piece by itself."""
        if self._mark is None or any(a in piece for piece in pieces for a in self._added):
            found = self._tokenizer.encode_batch([self._text(p) for p in pieces], add_special_tokens=False)
            return [f.ids for f in found]
        out, between = [], self._tokenizer.id_to_token(self._mark)
        for at in range(0, len(pieces), 256):
            found = self._fast(between.join([self._text(p) for p in pieces[at : at + 256]]) + between)
            ends = np.flatnonzero(found == self._mark)
            out += [ids[:-1].tolist() for ids in np.split(found, ends + 1)[:-1]]
        return out

    def _add(self, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first = self._store.add(ids, counts)
        self._known.update(zip(pieces, range(first, first + len(pieces))))

    def _add_letters(self, pieces: list[str]) -> None:
        """Take up words of plain letters, which blanks keep apart, where the ids show it."""
        for at in range(0, len(pieces), 256):
            some = pieces[at : at + 256]
            ids = self._fast(" " + " ".join(some) if self._spaced else " ".join(some))
            edges = np.flatnonzero(self._edge[ids])
            # The first id of every word, or its last one.
            bounds = np.append(edges, len(ids)) if self._spaced else np.append(-1, edges) + 1
            if len(edges) == len(some) and bounds[0] == 0 and bounds[-1] == len(ids):
                self._add(some, ids, np.diff(bounds))

    def _lowered(self, pieces: list[str]) -> list[str]:
        """In lower case, where that is the same in every version of Unicode; pieces hold no line end."""
        joined = "\n".join(pieces)
        if not _BEYOND.search(joined):
            return joined.lower().split("\n") if pieces else []
        return [piece if _BEYOND.search(piece) else piece.lower() for piece in pieces]

    def _learn(self, new: list[str]) -> None:
        """Remember new pieces; those with a word and punctuation behind it are put together."""
        known = self._known
        letters = [p for p in new if p.isalpha()]
        joined = "".join(letters)
        if _BEYOND.search(joined) or self._lower and joined != joined.lower():
            letters = [p for p in letters if not _BEYOND.search(p) and (not self._lower or p == p.lower())]
        self._add_letters(letters)
        new = [p for p in new if p not in known]
        plain = [p for p in new if p[:1] not in ("", _AS_IS, "\n")]
        other = [p for p in new if p[:1] in ("", _AS_IS, "\n")]
        words_ = self._lowered(plain) if self._lower else plain
        parts = [_split_tail(w) if w[-1] in _TAILS else (w, None) for w in words_]
        needed = {stem for stem, _ in parts}.union(other, (tail for _, tail in parts if tail is not None))
        missing = list(needed.difference(known))
        found = self._by_library(missing)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        self._add(missing, np.fromiter(itertools.chain.from_iterable(found), "<u4", counts.sum()), counts)
        known.update((piece, known[stem]) for piece, (stem, tail) in zip(plain, parts) if tail is None and piece is not stem)
        joined = [(piece, known[stem], known[tail]) for piece, (stem, tail) in zip(plain, parts) if tail is not None]
        if joined:
            both = np.array([pair[1:] for pair in joined], np.int64)
            self._add([j[0] for j in joined], self._store.join(both.ravel()), self._store.counts(both).sum(axis=1))

    def _forget(self) -> None:
        """Keep what was needed again, unless that is too much."""
        again = self._store.again
        pieces = [piece for piece, number in self._known.items() if again[number]]
        if len(pieces) > self._limit // 2:
            pieces = []
        numbers = np.fromiter(map(self._known.__getitem__, pieces), np.int64, len(pieces))
        self._known.clear()
        numbers, where = np.unique(numbers, return_inverse=True)
        ids, counts = self._store.join(numbers), self._store.counts(numbers)
        self._store = _Store()
        self._store.add(ids, counts)
        self._known = dict(zip(pieces, where.tolist()))

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        """Where the ids of distinct pieces are; new ones are learned."""
        if len(self._known) > self._limit:
            self._forget()
        before = self._store.size
        found = list(map(self._known.get, pieces))
        new = [k for k, number in enumerate(found) if number is None]
        if new:
            self._learn([pieces[k] for k in new])
            for k in new:
                found[k] = self._known[pieces[k]]
        numbers = np.fromiter(found, np.int64, len(pieces))
        self._store.again[numbers[numbers < before]] = True
        return numbers

    def _join(self, pieces: pa.Array, ends: np.ndarray) -> list[bytes]:
        """The ids of texts whose pieces stand end to end; the texts end at ``ends``."""
        coded = pieces.dictionary_encode()
        numbers = self._numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        numbers = numbers[coded.indices.to_numpy()]
        upto = 4 * np.append(0, np.cumsum(self._store.counts(numbers)))[ends]
        ids = memoryview(self._store.join(numbers).tobytes())
        return [bytes(ids[a:b]) for a, b in itertools.pairwise([0, *upto.tolist()])]

    def _by_arrow(self, texts: list[str]) -> list[bytes]:
        """Texts that blanks or white space cut."""
        if self._spaced:
            whole = pa.array([_AS_IS + text.replace("\n", " \n") for text in texts], pa.large_string())
            cut = pc.split_pattern(pc.replace_substring_regex(whole, _ENDED, _APART), " ")
        else:
            whole = pa.array(texts, pa.large_string())
            if self._lower:
                whole = pc.if_else(pa.array(map(_latin, texts), pa.bool_()), pc.utf8_lower(whole), whole)
            cut = pc.ascii_split_whitespace(pc.replace_substring_regex(whole, _ENDED, _APART))
        return self._join(cut.flatten(), cut.offsets.to_numpy()[1:])

    def _apart(self, text: str) -> bool:
        """Whether a text is cut in another way than by blanks or white space, or not at all."""
        spaces = self._spaced and any(two in text for two in _TWO)
        return spaces or any(a in text for a in self._added) or _odd(text)

    def _pieces(self, text: str) -> list[str]:
        if any(a in text for a in self._added):
            return [_AS_IS + text]
        return self._cut(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        apart = {k for k, text in enumerate(texts) if self._apart(text)}
        out: list[bytes] = [b""] * len(texts)
        plain = [k for k in range(len(texts)) if k not in apart]
        for k, ids in zip(plain, self._by_arrow([texts[k] for k in plain])):
            out[k] = ids
        if apart:
            cut = {k: self._pieces(texts[k]) for k in apart}
            ends = np.cumsum([len(c) for c in cut.values()])
            pieces = pa.array(itertools.chain.from_iterable(cut.values()), pa.large_string())
            for k, ids in zip(cut, self._join(pieces, ends)):
                out[k] = ids
        return out


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, cut: Callable[[str], list[str]]) -> Encoder:
    """The encoder of this worker process; what it has learned serves its later tasks too."""
    key = path, cut.__name__
    if key not in _encoders:
        _encoders[key] = Encoder(path, cut)
    return _encoders[key]


def batch_rows(batch, size: int = 1 << 21) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of some rows of a two-column batch at a time, of about ``size`` bytes; not all of it need be Python objects."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        rows = max(1, int(np.searchsorted(ends, before + size, "right")) - at)
        yield batch.column(0).slice(at, rows).to_pylist(), [t or "" for t in batch.column(1).slice(at, rows).to_pylist()]
        at += rows


def portions(texts: list[str | None], chars: int = 1 << 20, rows: int = 1 << 30) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``chars`` characters together, ``rows`` at most, with the index of the first."""
    start, held, size = 0, [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= chars or len(held) >= rows:
            yield start, held
            start, held, size = start + len(held), [], 0
    if held:
        yield start, held
