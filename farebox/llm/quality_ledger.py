"""Quality rules as a bit mask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements and one bit for each rule
that failed. A policy is a named, versioned set of bits: applying it, or asking what each of its rules
removes on its own, only works on the stored bits and never reads text again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3


class Rule(NamedTuple):
    """``failed`` is a SQL condition on the measurements; never null."""

    bit: int
    name: str
    failed: str


class Policy(NamedTuple):
    name: str
    version: int
    rules: tuple[str, ...]


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words OR word_chars > 16 * n_words"),
    Rule(5, "shouting", "2 * n_capitals > word_chars"),
    Rule(6, "exclamations", "2 * n_exclamations > n_words"),
)
BASE = Policy("base", 1, ("few_words", "repeated_words"))
PROSE = Policy("prose", 1, tuple(rule.name for rule in RULES))


def _count_of(chars: str) -> Column:
    text = F.col("text")
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _repeated_words() -> str:
    """Words inside windows of three that occur more than once, the first occurrence included.

    Sorting (hash, position) brings equal windows together; only texts with a repeat are sorted.
    """
    return f"""
    aggregate(
      sequence(0, size(repeat_starts) - 1),
      0L,
      (n, i) -> n + IF(i + 1 < size(repeat_starts), least({WINDOW}, repeat_starts[i + 1] - repeat_starts[i]), {WINDOW})
    )"""


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measurements per document: words, characters, symbols, repeated lines and windows.

    A null text counts as empty: all measurements are 0. Rows are neither merged nor dropped, so
    repeated rows and null ids stay; other columns are left out.
    """
    start = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    worded = start.select(
        "*",
        F.expr(f"filter(split(text, '{_sql(SPACE)}'), w -> w <> '')").alias("words"),
        F.expr("filter(split(text, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')").alias("lines"),
    )
    hashed = worded.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        _count_of(SYMBOLS).alias("n_symbols"),
        _count_of("!").alias("n_exclamations"),
        F.expr("CAST(regexp_count(text, '\\\\p{Lu}') AS BIGINT)").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            f"""IF(size(words) <= {WINDOW}, CAST(array() AS ARRAY<BIGINT>),
            transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64(words[i], words[i + 1], words[i + 2])))"""
        ).alias("windows"),
    )
    ordered = hashed.withColumn(
        "ordered",
        F.expr(
            """IF(size(windows) = size(array_distinct(windows)), NULL,
            sort_array(transform(windows, (h, i) -> named_struct('h', h, 'at', i))))"""
        ),
    ).drop("windows")
    starts = ordered.withColumn(
        "repeat_starts",
        F.expr(
            """IF(ordered IS NULL, NULL, sort_array(transform(filter(ordered, (x, i) ->
              (i > 0 AND ordered[i - 1].h = x.h) OR (i + 1 < size(ordered) AND ordered[i + 1].h = x.h)), x -> x.at)))"""
        ),
    ).drop("ordered")
    repeated = F.expr(f"IF(repeat_starts IS NULL, 0L, {_repeated_words()})")
    return starts.withColumn("n_repeat_words", repeated).drop("repeat_starts")


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


def ledger(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measurements with ``fail_bits``: bit ``b`` is set when the rule with that bit failed."""
    if len({rule.bit for rule in rules}) < len(rules):
        raise ValueError("two rules share a bit")
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.failed), F.lit(1 << rule.bit).cast("long")).otherwise(0))
    return measured.withColumn("fail_bits", bits)


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    bit = {rule.name: rule.bit for rule in rules}
    return sum(1 << bit[name] for name in policy.rules)


def passes(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a row of a ledger passes a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy, rules))) == 0


def ablation(book: DataFrame, policies: tuple[Policy, ...], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per policy and rule: documents that fail it, and that only this rule of the policy removes.

    One pass over the ledger: the distinct masks are counted first, so what follows has at most as
    many rows as there are combinations of bits. An empty ledger gives counts of 0.
    """
    counted = book.groupBy("fail_bits").agg(F.count("*").alias("n"))
    bit = {rule.name: rule.bit for rule in rules}
    sums, names = [], []
    for policy in policies:
        within = F.col("fail_bits").bitwiseAND(F.lit(mask(policy, rules)))
        for name in policy.rules:
            one = F.lit(1 << bit[name])
            for hit in (within.bitwiseAND(one) != 0, within == one):
                sums.append(F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias(f"c{len(sums)}"))
            names.append((policy, name))
    totals = counted.agg(*sums)
    rows = [
        F.struct(
            F.lit(policy.name).alias("policy"),
            F.lit(policy.version).alias("version"),
            F.lit(name).alias("rule"),
            F.col(f"c{2 * k}").alias("n_failed"),
            F.col(f"c{2 * k + 1}").alias("n_only"),
        )
        for k, (policy, name) in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*rows)))
