"""The corpus pipeline: five stages of the corpus operators over ``documents``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  ``run`` writes what a stage returns as Parquet into the
shared folder and rereads it as the next stage's ``docs``, so every stage works
on all its predecessor kept and an executor loss never reaches back over a
stage boundary.  All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gocledger.llm import decontam, mixing, sharding, simhash, toxicity
from gocledger.llm.common import Scratch, read


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (9): documents that the classifier chain rejects go."""
    return toxicity.remove_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (4), with its contract's shingle length and bit distance: one document of each group stays."""
    return simhash.keep_one_per_group(docs, Scratch(spark), k=simhash.SHINGLE_WORDS, max_bits=simhash.MAX_BITS)


def contaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (10): documents that hold a benchmark window go."""
    return decontam.remove_contaminated(docs, read(spark, sf_dir, "benchmark"), Scratch(spark))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights (8): a document stands as often as the mix takes it."""
    return mixing.apply_mix(docs, read(spark, sf_dir, "labels"), Scratch(spark))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding (2): the columns of ``docs`` plus shard and slot."""
    return sharding.shuffle_into_shards(docs, n_shards=sharding.N_SHARDS).drop("bucket", "bucket_slot")


STAGES = [
    ("toxicity", toxic_documents),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", contaminated_documents),
    ("mixing", mixed_sources),
    ("sharding", shards),
]

#: Fingerprints, trained models and seeded shuffles cannot be expressed in SQL; tests hold
#: the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole ``documents`` table; the last stage's rows."""
    scratch = Scratch(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = scratch.mark()
        docs = scratch.cut(stage(spark, docs, sf_dir), f"stage-{name}")
        scratch.drop(max(0, before - 1), before)
    return docs
