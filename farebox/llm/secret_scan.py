"""Secret scan: three exact patterns plus sliding-window entropy over candidate strings.

Candidates are maximal runs of the characters of a class. For each, a window of fixed width slides over
the string; entering and leaving characters change their counts and the running sum of ``c * log2(c)``,
from which the Shannon entropy of the window follows. The highest entropy decides. Strings that match
the allow list are suppressed before any entropy is computed.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

# The patterns of the base kinds.
_KEYWORD = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
_VALUE = "([A-Za-z0-9+/_.=-]+)"
ASSIGN = _KEYWORD + r"[\"\x27]?\x20*[:=]\x20*[\"\x27]?" + _VALUE
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"


class EntropyClass(NamedTuple):
    """Strings of ``shortest`` or more of ``alphabet`` whose best window reaches ``bits``."""

    kind: str
    alphabet: str
    pattern: str
    shortest: int
    bits: float


# 20 characters of a random hex string have 3.3 bits on average, of a base64 string 4.1.
ENTROPY_CLASSES = (
    EntropyClass("entropy_hex", "0123456789abcdefABCDEF", "[0-9a-fA-F]", 24, 2.9),
    EntropyClass(
        "entropy_base64",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
        "[A-Za-z0-9+/_=-]",
        24,
        3.75,
    ),
)
# Words and words joined by signs, numbers, UUIDs, paths of words.
ALLOW_LIST = (
    r"[A-Za-z+/_=-]+",
    r"[0-9+/_=-]+",
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"([A-Za-z]{3,}[0-9]{0,4}[/_=+-]+)+([A-Za-z]{3,}[0-9]{0,4}|[0-9]{1,4})?",
)
WIDTH = 20
# Matches whose offsets are added up together; bounds the work of growing arrays.
_BLOCK = 512
_NO_SPANS = "CAST(array() AS ARRAY<STRUCT<at: INT, rank: INT, until: INT, body: STRING>>)"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _offsets(pattern: str, rank: int, text: str = "__scanned") -> str:
    """SQL for the spans of all matches of ``pattern`` in the column ``text``, in code points.

    The text between the matches and the matches alternate, so offsets are running sums of their
    lengths. They are summed in blocks: the start of a block first, then the members of each block.
    """
    p = _quoted(pattern)
    return f"""
    IF(NOT {text} rlike {p}, {_NO_SPANS},
      element_at(transform(array(named_struct('gap', split({text}, {p}, -1), 'hit', regexp_extract_all({text}, {p}, 0))), m ->
        flatten(aggregate(
          sequence(0, CAST(floor((size(m.hit) - 1) / {_BLOCK}) AS INT)),
          named_struct('at', 0, 'found', CAST(array() AS ARRAY<ARRAY<STRUCT<at: INT, rank: INT, until: INT, body: STRING>>>)),
          (done, b) -> element_at(transform(array(aggregate(
              sequence(b * {_BLOCK}, least(b * {_BLOCK} + {_BLOCK}, size(m.hit)) - 1),
              named_struct('at', done.at, 'found', {_NO_SPANS}),
              (acc, i) -> named_struct(
                'at', acc.at + length(m.gap[i]) + length(m.hit[i]),
                'found', concat(acc.found, array(named_struct(
                  'at', acc.at + length(m.gap[i]), 'rank', {rank},
                  'until', acc.at + length(m.gap[i]) + length(m.hit[i]), 'body', m.hit[i])))))),
            block -> named_struct('at', block.at, 'found', concat(done.found, array(block.found)))), 1),
          done -> done.found))), 1))"""


def _entropy(body: str, alphabet: str) -> str:
    """SQL for the highest entropy, in bits, of the windows of a string of at least ``WIDTH`` characters."""
    term = "IF({c} <= 1, 0.0D, {c} * log2({c}))"

    def change(count: str, step: str) -> str:
        return f"({term.format(c=f'({count} {step})')} - {term.format(c=count)})"

    # The characters are looked up once, so a step costs the same wherever it is in a long string. When
    # the same character enters and leaves, nothing changes; otherwise the two changes are independent.
    return f"""
    element_at(transform(array(transform(split({body}, ''), ch -> instr({_quoted(alphabet)}, ch) - 1)), codes -> aggregate(
      sequence(1, size(codes)),
      named_struct('n', array_repeat(0, {len(alphabet)}), 'sum', 0.0D, 'best', 0.0D),
      (s, i) -> element_at(transform(array(named_struct(
          'into', codes[i - 1], 'out', IF(i > {WIDTH}, codes[greatest(i - {WIDTH} - 1, 0)], -1))), x ->
        element_at(transform(array(
            s.sum + IF(x.into = x.out, 0.0D,
              {change("s.n[x.into]", "+ 1")}
              + IF(x.out < 0, 0.0D, {change("s.n[greatest(x.out, 0)]", "- 1")}))), total ->
          named_struct(
            'n', IF(x.into = x.out, s.n, transform(s.n, (c, k) -> c + IF(k = x.into, 1, 0) - IF(k = x.out, 1, 0))),
            'sum', total,
            'best', IF(i >= {WIDTH}, greatest(s.best, log2({WIDTH}.0D) - total / {WIDTH}.0D), s.best))), 1)), 1),
      s -> s.best)), 1)"""


def find_spans(
    docs: DataFrame,
    text: str = "text",
    classes: tuple[EntropyClass, ...] = ENTROPY_CLASSES,
    allow: tuple[str, ...] = ALLOW_LIST,
    into: str = "spans",
) -> DataFrame:
    """The rows with a column ``into``: structs (at, rank, until, body), ordered by start, then kind.

    ``rank`` counts assign, access, hex and then the entropy classes. All columns of the rows stay. A
    null or empty text has no spans. Spans of different kinds may overlap; those of one kind do not.
    """
    if any(c.shortest < WIDTH for c in classes):
        raise ValueError(f"candidates must have {WIDTH} characters at least")
    found = [
        f"filter({_offsets(ASSIGN, 0)}, x -> length(regexp_extract(x.body, {_quoted(ASSIGN)}, 2)) >= 6)",
        _offsets(ACCESS, 1),
        _offsets(HEX, 2),
    ]
    allowed = _quoted("^(?:" + "|".join(allow) + ")$") if allow else None
    for rank, c in enumerate(classes, 3):
        hits = _offsets(f"{c.pattern}{{{c.shortest},}}", rank)
        listed = f"NOT x.body rlike {allowed} AND " if allowed else ""
        found.append(f"filter({hits}, x -> {listed}{_entropy('x.body', c.alphabet)} >= {c.bits}D)")
    scan = docs.withColumn("__scanned", F.coalesce(F.col(text), F.lit("")))
    return scan.withColumn(into, F.sort_array(F.concat(*map(F.expr, found)))).drop("__scanned")


def kind_names(classes: tuple[EntropyClass, ...] = ENTROPY_CLASSES) -> list[str]:
    return ["assign", "access", "hex", *[c.kind for c in classes]]


def listed(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat(
                F.element_at(names, x["rank"] + 1), F.lit(":"), x["at"].cast("string"), F.lit(":"), x["until"].cast("string")
            ),
        ),
        ",",
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every run of overlapping spans replaced by ``mark``; unchanged without spans."""
    merged = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,until:int>>").alias("kept")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["until"]).alias("at"),
            F.when(
                x["at"] < s["at"], s["kept"]
            ).otherwise(F.concat(s["kept"], F.array(F.struct(s["at"].alias("at"), x["at"].alias("until"))))).alias("kept"),
        ),
        lambda s: F.concat(s["kept"], F.array(F.struct(s["at"].alias("at"), F.lit(2147483647).alias("until")))),
    )
    pieces = F.transform(merged, lambda g: F.substring(text, g["at"] + 1, g["until"] - g["at"]))
    return F.when(F.size(spans) > 0, F.array_join(pieces, mark)).otherwise(text)
