"""One query per operator, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm import (
    adaptive_rules,
    compact_windows,
    embedding_lsh,
    framed_records,
    line_dedup,
    packing,
    periodic_runs,
    piece_bpe,
    positional_index,
    quality_bayes,
    simhash,
    source_divergence,
    token_counts,
)
from tilth.llm.common import Stages, read_table
from tilth.session import use_utc

QUERIES: dict[str, object] = {}
ORACLES: dict[str, str] = {}
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark, folder) -> DataFrame:
    return token_counts.token_counts(use_utc(spark), read_table(spark, folder, "documents"), BYTE_BPE)


@query
def op2_quality_bayes(spark, folder) -> DataFrame:
    docs, labels = (read_table(use_utc(spark), folder, t) for t in ("documents", "labels"))
    return quality_bayes.document_quality(docs, labels, Stages(spark, "quality"))


@query
def op3_line_dedup(spark, folder) -> DataFrame:
    return line_dedup.line_groups(read_table(use_utc(spark), folder, "documents"), Stages(spark, "lines"), least_words=1)


@query
def op4_framed_records(spark, folder) -> DataFrame:
    return framed_records.token_records(use_utc(spark), read_table(spark, folder, "documents"), BYTE_BPE, end_id=2)


@query
def op7_packing(spark, folder) -> DataFrame:
    docs = read_table(use_utc(spark), folder, "documents")
    return packing.pack_documents(docs, Stages(spark, "packing"), BYTE_BPE, end_id=0, capacity=1024).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op8_embedding_lsh(spark, folder) -> DataFrame:
    return embedding_lsh.near_embeddings(read_table(use_utc(spark), folder, "embeddings"), Stages(spark, "embeddings"), 0.95)


@query
def op9_compact_windows(spark, folder) -> DataFrame:
    return compact_windows.repeated_passages(read_table(use_utc(spark), folder, "documents"), Stages(spark, "passages"))


@query
def op10_simhash(spark, folder) -> DataFrame:
    groups = simhash.simhash_groups(read_table(use_utc(spark), folder, "documents"), Stages(spark, "simhash"))
    return groups.select("doc_id", simhash.hexed(groups["fp"]).alias("fingerprint"), "component_id")


@query
def op5_piece_bpe(spark, folder) -> DataFrame:
    return piece_bpe.round_trip_digests(read_table(use_utc(spark), folder, "documents"), PIECE_BPE)


@query
def op6_adaptive_rules(spark, folder) -> DataFrame:
    rows = adaptive_rules.judged(read_table(use_utc(spark), folder, "documents"), Stages(spark, "rules"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one document in ten, by checksum of its id, goes on from
    some word on as a repeat of the words from there. No id, no repeat."""
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", r"[ \t-\r]+"), "")))
    rows = rows.withColumns({"n": F.size("w").cast("long"), "g": F.floor(F.col("h") / 10)})
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, w[cast(a + (i - a) % p as int)])), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark, folder) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_repeats(read_table(use_utc(spark), folder, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"), (-F.col("longest.less")).alias("length"),
        F.col("longest.period").alias("period"), F.expr("1000 * -longest.less div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op12_positional_index(spark, folder) -> DataFrame:
    docs, items = (read_table(use_utc(spark), folder, t) for t in ("documents", "benchmark"))
    hits = positional_index.document_hits(positional_index.benchmark_matches(docs, items, Stages(spark, "positions")))
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op13_source_divergence(spark, folder) -> DataFrame:
    return source_divergence.divergences(read_table(use_utc(spark), folder, "documents"), Stages(spark, "divergence"))


ORACLES["op6_adaptive_rules"] = adaptive_rules.SQL
ORACLES["op12_positional_index"] = positional_index.SQL
ORACLES["op13_source_divergence"] = source_divergence.SQL
