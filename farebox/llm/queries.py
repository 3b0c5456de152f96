"""The registered queries of this package, on whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from farebox.llm import (
    chat_tools,
    decontaminate,
    fill_middle,
    jaccard_join,
    language_id,
    mixing,
    packing,
    periodic_runs,
    quality_ledger,
    repeats,
    secret_scan,
    sql,
    token_files,
    url_filter,
)
from farebox.llm.tables import read_table
from farebox.sources.scratch import scratch_path

# The rules the URL query is asked to apply.
URL_RULES = (
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)


def learned_languages(docs: DataFrame) -> language_id.LanguageModel:
    """A model from the rows that are not held out."""
    return language_id.fit(docs.where(~held_out()).select("doc_id", "text", "lang"))


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    found = language_id.predict_languages(docs, learned_languages(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page, carried over canonical and redirect links."""
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    return url_filter.judge_urls(pages, url_filter.page_links(pages), URL_RULES)


def op3_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that start elsewhere too."""
    left = repeats.remove_repeats(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return left.select("doc_id", "n_bytes", "n_removed", n_spans, F.sha2("kept", 256).alias("kept_sha256"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under links of 80 % shared five-word shingles."""
    return jaccard_join.similar_classes(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and the verdict of the prose policy for every document."""
    book = quality_ledger.ledger(quality_ledger.measure(read_table(spark, sf_dir, "documents", ["doc_id", "text"])))
    base, kept = quality_ledger.passes(quality_ledger.BASE), quality_ledger.passes(quality_ledger.PROSE)
    return book.select(
        *["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        (~base).alias("base_failed"),
        (base & kept).alias("kept"),
        "fail_bits",
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base kinds and all spans of every document."""
    found = secret_scan.find_spans(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    kinds = secret_scan.kind_names()
    n = [F.expr(f"CAST(size(filter(spans, x -> x.rank = {rank})) AS BIGINT)") for rank in range(3)]
    base = F.filter("spans", lambda x: x["rank"] < 3)
    return found.select(
        "doc_id",
        n[0].alias("n_assign"),
        n[1].alias("n_access"),
        n[2].alias("n_hex"),
        F.sha2(secret_scan.listed(base, kinds), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans"), kinds).alias("spans"),
    )


# Tools that the turns of the conversations stand for.
TOOLS = {
    "configure": {
        "type": "object",
        "properties": {"instructions": {"type": "string", "minLength": 1}},
        "required": ["instructions"],
        "additionalProperties": False,
    },
    "ask": {
        "type": "object",
        "properties": {
            "question": {"type": "string", "minLength": 1, "maxLength": 2000},
            "words": {"type": "integer", "minimum": 3},
        },
        "required": ["question", "words"],
        "additionalProperties": False,
    },
}


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as tool calls: system and user turns call, an assistant turn answers the turn before it.

    Every call comes after the call one or two turns before it, so those of a conversation form a chain.
    Their identifiers are unique in a conversation only. Turns of other roles are neither call nor result.
    """
    turns = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])

    def call_id(back: int):
        return F.concat(F.lit("call_"), (F.col("turn") - back).cast("string"))

    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    asked = F.to_json(F.struct(words.alias("words"), F.col("text").alias("question")))
    told = F.to_json(F.struct(F.col("text").alias("instructions")))
    calls = turns.where("role IN ('system', 'user')").select(
        "conv_id",
        call_id(0).alias("call_id"),
        "turn",
        F.when(F.col("role") == "user", "ask").otherwise("configure").alias("name"),
        F.when(F.col("role") == "user", asked).otherwise(told).alias("arguments"),
        F.array(call_id(1), call_id(2)).alias("after"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", call_id(1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return chat_tools.link_calls(calls, results, TOOLS)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 tokens."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to token files and read back."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, path, with_ids=False)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark, with the item."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return decontaminate.find_leaks(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def looped(text: Column, doc_id: Column) -> Column:
    """A tenth of the texts end in a loop: from some word on, a few words again and again."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    n = F.size(words).cast("long")
    start = g % n
    period = 1 + F.floor((n - start) / (3 + g % 8))
    # No lambda here: its body would take the text apart again for every word.
    turn = F.slice(words, (start + 1).cast("int"), period.cast("int"))
    turns = F.flatten(F.array_repeat(turn, F.ceil((n - start) / period).cast("int")))
    loop = F.array_join(F.slice(F.concat(F.slice(words, 1, start.cast("int")), turns), 1, n.cast("int")), " ")
    return F.when((h % 10 == 0) & F.rlike(text, F.lit(r"[^\x20\x09-\x0D]")), loop).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, a tenth of which loop, and what is left without them.

    A null id has no decimal form, so its text is taken as it is.
    """
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    docs = docs.withColumn("text", looped(F.col("text"), F.col("doc_id")))
    found = periodic_runs.find_runs(docs)
    ranked = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    best = F.array_max(ranked)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.expr("1000 * best.length DIV -best.col3").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix of all sources takes."""
    mix = mixing.mix_sources(read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"]))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mix.select("doc_id", "size", "source_size", "target", taken, "copies", "source")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut in three at line ends and rearranged, and the text rebuilt from that."""
    return fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), with_output=False)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_url_filter": op2_url_filter,
    "op3_suffix_repeats": op3_suffix_repeats,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_quality_rules": op5_quality_rules,
    "op6_secret_scan": op6_secret_scan,
    "op7_tool_calls": op7_tool_calls,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_token_files": op9_token_files,
    "op10_decontamination": op10_decontamination,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_source_mix": op12_source_mix,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLES = {
    "op2_url_filter": sql.URL_FILTER,
    "op5_quality_rules": sql.QUALITY_RULES,
    "op6_secret_scan": sql.SECRET_SCAN,
    "op7_tool_calls": sql.TOOL_CALLS,
    "op13_fill_in_middle": sql.FILL_IN_MIDDLE,
}
