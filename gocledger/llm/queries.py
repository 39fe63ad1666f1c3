"""The registered queries of the corpus operators: each applies one operator, with
production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gocledger.llm import (
    conversations, decontam, embeddings, langid, licenses, linedup, merkle, mixing, oracle, sharding, simhash, spans,
    topk, toxicity)
from gocledger.llm.common import Scratch, null_safe, read

Query = Callable[[SparkSession, str], DataFrame]


def op1_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = spans.remove_repeated_spans(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_sentences", "n_removed", (F.col("n_removed") > 0).alias("changed"), "text")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    sharded = sharding.shuffle_into_shards(docs, n_shards=sharding.N_SHARDS)
    text = F.coalesce(F.col("text"), F.lit(""))
    return sharded.select(
        "doc_id", sharding.record_bytes(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot",
        sharding.shard_of(F.col("doc_id"), sharding.N_SHARDS + 1).cast("int").alias("grown_shard"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(read(spark, sf_dir, "documents"), Scratch(spark))
    return groups.select("doc_id", simhash.hex_fingerprint(F.col("fingerprint_bits")).alias("fingerprint"),
                         "component_id")


def held_out(doc_id: F.Column) -> F.Column:
    """Documents that language identification never learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~held_out(F.col("doc_id"))))
    found = langid.predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(read(spark, sf_dir, "embeddings"), Scratch(spark))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scratch = Scratch(spark)
    removed = scratch.cut(linedup.repeated_lines(docs, scratch), "removed-lines")
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                       F.coalesce(F.regexp_count("text", F.lit("\n")) + 1, F.lit(0)).cast("long").alias("n_lines"))
    met = null_safe(slim, removed, ["doc_id", "text_key"], "left")
    return met.select("doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce("removed", F.array().cast("array<int>")).alias("removed_lines"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    _, rows = mixing.mix(docs.select("doc_id", "text", "source"), labels, Scratch(spark))
    return rows.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"),
                       (F.col("copies") * F.col("size")).alias("taken"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    return toxicity.predict(docs, toxicity.train(docs, labels), keep=["doc_id"])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontam.annotate(docs, read(spark, sf_dir, "benchmark"), Scratch(spark), keep=["doc_id"])
    hit = decontam.hit_words(F.col("hit_starts"), F.col("hit_ends"))
    return marked.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, Scratch(spark), k=topk.K)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(*merkle.FIELDS)
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = merkle.leaf_digest([lowered if f == "text" else F.col(f) for f in merkle.FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    made = merkle.manifest(docs, Scratch(spark), keep={
        "doc_id": F.col("doc_id"), "tampered": F.when(hit, F.unhex(changed))})
    root = F.lit(made.root).cast("string")
    folded = merkle.fold(F.coalesce(F.lower(F.hex("tampered")), F.col("leaf")), F.col("path"))
    return made.proofs.select(
        "doc_id", "leaf", "subroot", root.alias("root"), merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == root).alias("verified"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.repair_report(conversations.damaged(rows))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_spans, op2_sharding, op3_licenses, op4_simhash, op5_language, op6_embeddings, op7_lines, op8_mixing,
        op9_toxicity, op10_decontamination, op11_topk, op12_merkle, op13_conversations)}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
