"""Sharding by a two-pass external shuffle.

Pass 1 scatters every record by seeded hashes: the shard by rendezvous hashing of
``doc_id`` over the shard numbers (law ``key``: adding a shard moves rows only
into the new one), and within the shard a bucket of bounded bytes, by a hash of
the record and its place in its input split, so that neither copies of one text
nor repeated rows gather in one bucket.  Pass 2 loads one bucket at a time, puts
it into a canonical order, shuffles it with Fisher-Yates seeded by (seed, shard,
bucket) and lays the buckets of a shard end to end: ``slot`` is the row's place
in its shard.

Only sums and one row per bucket are gathered beyond that: the number of buckets
follows the measured bytes, so a bucket stays memory-sized at any input size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gocledger.llm.common import without

SEED = 20_240
N_SHARDS = 24
BUCKET_BYTES = 16 << 20
#: Buckets whose offsets may be broadcast (24 bytes each).
BROADCAST_ROWS = 1 << 20
#: Bytes that a record counts besides its text.
ROW_BYTES = 8

ADDED = ("shard", "bucket", "bucket_slot", "slot")


def shard_of(doc_id: F.Column, n_shards: int, seed: int = SEED) -> F.Column:
    """Rendezvous hash: the shard whose seeded hash with the key is largest (ties: the smaller shard).

    Each shard's hash does not depend on the number of shards, so one more shard
    either wins a row or leaves it where it was.  A null key hashes as its own value.
    """
    key = F.coalesce(doc_id.cast("string"), F.lit("\0"))
    bids = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), key).alias("h"), F.lit(-s).alias("s")) for s in range(n_shards)]
    return -F.array_max(F.array(*bids))["s"] if n_shards > 1 else F.lit(0)


def record_bytes(text: F.Column) -> F.Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)).cast("long")


def _shuffle_bucket(seed: int, names: list[str]):
    """applyInArrow function: canonical order, then Fisher-Yates over one bucket's rows."""
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("__order").to_numpy(), kind="stable")
        rng = np.random.Generator(np.random.PCG64([seed, table.column("shard")[0].as_py(), table.column("bucket")[0].as_py()]))
        for i in range(len(order) - 1, 0, -1):
            j = int(rng.integers(0, i + 1))
            order[i], order[j] = order[j], order[i]
        out = table.take(pa.array(order)).append_column("bucket_slot", pa.array(np.arange(len(order), dtype=np.int64)))
        return out.select([*names, "shard", "bucket", "bucket_slot"])

    return run


def shuffle_into_shards(docs: DataFrame, *, n_shards: int = N_SHARDS, bucket_bytes: int = BUCKET_BYTES,
                        seed: int = SEED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` plus shard (int), bucket (int), bucket_slot (long) and slot (long, gapless from 0 in its shard).

    Null doc_ids form one key (one shard, many buckets); null and empty texts
    weigh the fixed record bytes; repeated rows are kept, each with a slot of its
    own; input columns named like an added one are replaced.  A text longer than
    a bucket makes its bucket larger by itself.  No rows: no rows.
    """
    if n_shards < 1 or bucket_bytes < 1:
        raise ValueError("n_shards and bucket_bytes must be positive")
    base = without(docs, ADDED)
    total = base.agg(F.sum(record_bytes(F.col(text))).alias("b")).first()["b"] or 0
    n_buckets = max(1, math.ceil(total / n_shards / bucket_bytes))
    names = base.columns
    record = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    scattered = (base.withColumn("shard", shard_of(F.col(doc_id), n_shards, seed).cast("int"))
                 .withColumn("__order", record)
                 .withColumn("bucket", F.pmod(F.xxhash64(F.col("__order"), F.monotonically_increasing_id()),
                                              F.lit(n_buckets)).cast("int")))
    schema = T.StructType([*base.schema, T.StructField("shard", T.IntegerType()), T.StructField("bucket", T.IntegerType()),
                           T.StructField("bucket_slot", T.LongType())])
    dealt = scattered.groupBy("shard", "bucket").applyInArrow(_shuffle_bucket(seed, names), schema)
    sizes = scattered.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("shard").alias("__s"), F.col("bucket").alias("__b"),
                           F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__ahead"))
    # One row of 24 bytes per bucket: broadcast while that is small, else joined by a shuffle.
    if n_shards * n_buckets <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    return (dealt.join(offsets, (F.col("shard") == F.col("__s")) & (F.col("bucket") == F.col("__b")))
            .withColumn("slot", F.col("__ahead") + F.col("bucket_slot")).select(*names, *ADDED))


def write_shards(sharded: DataFrame, path: str) -> None:
    """The shards as Parquet folders shard=0, shard=1, ..., each bucket one sorted run of files."""
    (sharded.repartition("shard", "bucket").sortWithinPartitions("shard", "bucket", "bucket_slot")
     .write.mode("overwrite").partitionBy("shard").parquet(path))
