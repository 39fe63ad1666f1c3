"""Embedding near-duplicates by cross-polytope hashing.

Vectors are rotated pseudo-randomly (three rounds of random signs and a fast
Hadamard transform); a hash names the closest vertex of the cross-polytope, that
is the largest coordinate and its sign.  ``width`` hashes make a bucket, several
tables are kept, and every vector stands in its ``probes`` best buckets of each
table (multiprobe: the next-best vertices by what they lose).  Vectors that meet
in a bucket are verified by their cosine in double precision.

The number of hashes in a bucket follows the number of vectors (so buckets stay
small), and the number of tables follows from the measured chance that two
vectors at the threshold meet, for a recall of ``recall`` at the threshold; pairs
that are closer meet more often.

Equal vectors collapse to one class first.  A bucket larger than ``block`` is cut
into chunks and every pair of chunks is a task of its own.  A task emits one row
per member: how many links it found there for the first time (pairs that met in
an earlier bucket are counted there) and the member's tree edge for the
distributed union-find; it never emits the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gocledger.llm.common import Scratch
from gocledger.llm.components import connected_components

COSINE = 0.95
RECALL = 0.999
PROBES = 3
BUCKET_ROWS = 64
BLOCK = 1024
SEED = 6
_MAX_TABLES = 64


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row (length a power of two)."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


class Hasher:
    """Cross-polytope buckets for vectors of one length."""

    def __init__(self, dims: int, width: int, tables: int, probes: int = PROBES, seed: int = SEED) -> None:
        self.dims, self.width, self.tables, self.probes = dims, width, tables, probes
        self.size = max(2, 1 << (dims - 1).bit_length())
        rng = np.random.Generator(np.random.PCG64([seed, dims]))
        self.signs = rng.choice([-1.0, 1.0], size=(tables, width, 3, self.size))

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """Bucket numbers (rows, tables, probes); the first of each table is the home bucket."""
        out = np.zeros((len(unit), self.tables, self.probes), dtype=np.int64)
        padded = np.zeros((len(unit), self.size))
        padded[:, :self.dims] = unit
        alt = min(self.probes, self.size)
        for t in range(self.tables):
            loss = np.zeros((len(unit), 1))
            code = np.zeros((len(unit), 1), dtype=np.int64)
            for k in range(self.width):
                x = padded
                for r in range(3):
                    x = _hadamard(x * self.signs[t, k, r])
                big = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :alt]
                val = np.take_along_axis(x, big, axis=1)
                vertex = 2 * big + (val < 0)
                # Distance to a vertex grows as its coordinate falls short of the largest.
                miss = (np.abs(val[:, :1]) - np.abs(val)) ** 2
                loss = (loss[:, :, None] + miss[:, None, :]).reshape(len(unit), -1)
                code = (code[:, :, None] * (2 * self.size) + vertex[:, None, :]).reshape(len(unit), -1)
                best = np.argsort(loss, axis=1, kind="stable")[:, :self.probes]
                loss, code = np.take_along_axis(loss, best, axis=1), np.take_along_axis(code, best, axis=1)
            out[:, t, :code.shape[1]] = code
            out[:, t, code.shape[1]:] = code[:, :1]
        return out


def plan(n: int, dims: int, cosine: float, recall: float, probes: int = PROBES, seed: int = SEED) -> tuple[int, int]:
    """(width, tables): buckets of about BUCKET_ROWS of n vectors, and tables enough that two
    vectors at the threshold meet with probability ``recall`` (measured on seeded random pairs).

    Where that takes more than _MAX_TABLES tables, the width is lowered: buckets grow, recall is kept.
    ValueError if no width will do."""
    size = max(2, 1 << (dims - 1).bit_length())
    width = max(1, math.ceil(math.log(max(n / BUCKET_ROWS, 2)) / math.log(2 * size)))
    width = min(width, 62 // int(math.log2(2 * size)))
    if dims < 2:
        return 1, 1
    rng = np.random.Generator(np.random.PCG64([seed, 1]))
    a = rng.standard_normal((2000, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, dims))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = cosine * a + math.sqrt(max(0.0, 1 - cosine * cosine)) * b
    for w in range(width, 0, -1):
        probe = Hasher(dims, w, 4, probes, seed + 1)
        x, y = probe.buckets(a), probe.buckets(b)
        meet = float((x[:, :, :, None] == y[:, :, None, :]).any(axis=(2, 3)).mean())
        tables = math.ceil(math.log(1 - recall) / math.log(1 - min(max(meet, 1e-3), 1 - 1e-9)))
        if tables <= _MAX_TABLES:
            return w, max(1, tables)
    raise ValueError(f"recall {recall} at cosine {cosine} needs {tables} tables of {dims} dimensions, more than {_MAX_TABLES}")


def _signatures(hashers: dict[int, Hasher]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("vector"))
            raw: list[bytes] = [b""] * len(batch)
            flat: list[np.ndarray] = [np.zeros(0, np.int64)] * len(batch)
            lengths = np.array([len(v) for v in vectors])
            for d in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == d)
                x = np.stack([vectors[i].values.to_numpy(zero_copy_only=False) for i in rows.tolist()]).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                sig = hashers[d].buckets(x).reshape(len(rows), -1)
                for i, v, s in zip(rows.tolist(), x, sig):
                    raw[i], flat[i] = v.tobytes(), s
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("cid")), batch.column(batch.schema.get_field_index("copies")),
                 pa.array(raw, pa.binary()), pa.array(flat, pa.list_(pa.int64()))],
                names=["cid", "copies", "unit", "sig"])

    return run


def _links(cosine: float, probes: int):
    """mapInArrow function over rows sorted by (dims, slot, bucket, partner): one row per member and task."""
    def solve(g: dict[str, list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cid, copies = np.array(g["cid"]), np.array(g["copies"])
        unit = np.frombuffer(b"".join(g["unit"]), np.float64).reshape(len(cid), -1)
        sig = np.stack(g["sig"]).reshape(len(cid), -1, probes)
        chunk, partner = np.array(g["chunk"]), g["partner"][0]
        table, bucket = g["table"][0], g["bucket"][0]
        a, b = np.flatnonzero(chunk == partner // (1 << 20)), np.flatnonzero(chunk == partner % (1 << 20))
        found = np.zeros(len(cid), np.int64)
        label = np.arange(len(cid))
        cos = unit[a] @ unit[b].T
        i, j = np.nonzero(cos >= cosine)
        i, j = a[i], b[j]
        once = i < j if partner // (1 << 20) == partner % (1 << 20) else np.ones(len(i), bool)
        i, j = i[once], j[once]
        for at in range(0, len(i), 1 << 16):
            p, q = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
            same = sig[p][:, :table + 1, :, None] == sig[q][:, :table + 1, None, :]
            early = same[:, :table].any(axis=(1, 2, 3))
            now = same[:, table] & (sig[p][:, table, :, None] < bucket)
            first = ~(early | now.any(axis=(1, 2)))
            np.add.at(found, p[first], copies[q[first]])
            np.add.at(found, q[first], copies[p[first]])
        while len(i):
            x, y = label[i], label[j]
            apart = x != y
            if not apart.any():
                break
            np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            label = label[label]
        while not (label[label] == label).all():
            label = label[label]
        use = np.flatnonzero((found > 0) | (label != np.arange(len(cid))))
        return cid[use], found[use], cid[label[use]]

    names = ("cid", "copies", "unit", "sig", "table", "bucket", "chunk", "partner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: dict[str, list] = {n: [] for n in names}
        task = None
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(np.concatenate(x)) for x in zip(*out)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["cid", "found", "root"])

        for batch in batches:
            cols = {}
            for n in names:
                c = batch.column(batch.schema.get_field_index(n))
                cols[n] = c.to_pylist() if n != "sig" else [s.values.to_numpy() for s in c]
            keys = list(zip(cols["table"], cols["bucket"], cols["partner"], map(len, cols["unit"])))
            at = 0
            while at < len(keys):
                end = at
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if keys[at] != task:
                    if task is not None and len(group["cid"]) > 1:
                        out.append(solve(group))
                    group = {n: [] for n in names}
                    task = keys[at]
                for n in names:
                    group[n] += cols[n][at:end]
                at = end
            if len(out) >= 256:
                yield flush()
        if task is not None and len(group["cid"]) > 1:
            out.append(solve(group))
        if out:
            yield flush()

    return run


def near_duplicates(vectors: DataFrame, scratch: Scratch, *, cosine: float = COSINE, recall: float = RECALL,
                    probes: int = PROBES, block: int = BLOCK, seed: int = SEED, vec_id: str = "vec_id",
                    embedding: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly), component_id (smallest
    vec_id reachable, itself included).

    Linked: cosine >= ``cosine``, found in a common bucket.  Null and zero vectors
    and vectors with null or non-finite components link with nothing, nor do
    vectors of different lengths.  Equal vectors are links of each other; repeated
    vec_ids are vectors of their own; a null vec_id is component_id only where no
    other is reachable.  No rows: no rows.
    """
    v = F.col(embedding)
    ok = F.coalesce(
        (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), v.alias("vector"), ok.alias("ok"))
    keyed = rows.withColumns({"h1": F.when(F.col("ok"), F.xxhash64("vector")),
                              "h2": F.when(F.col("ok"), F.xxhash64(F.lit(seed), F.col("vector"), F.size("vector")))})
    classes = (keyed.where("ok").groupBy("h1", "h2")
               .agg(F.first("vector").alias("vector"), F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes, n = scratch.cut_counted(classes, "vector-classes")
    lengths = [r[0] for r in classes.select(F.size("vector")).distinct().collect()]
    plans = {d: plan(n, d, cosine, recall, probes, seed) for d in lengths}
    hashers = {d: Hasher(d, *p, probes, seed) for d, p in plans.items()}
    sigs = scratch.cut(classes.select("cid", "copies", "vector").mapInArrow(
        _signatures(hashers), "cid long, copies long, unit binary, sig array<long>"), "vector-signatures")
    dims = F.octet_length("unit").alias("dims")
    slots = (sigs.select("cid", dims, F.posexplode(F.array_distinct(
        F.transform("sig", lambda b, i: F.struct(F.floor(i / probes).cast("int").alias("table"), b.alias("bucket"))))))
        .select("cid", "dims", "col.table", "col.bucket"))
    place = ["dims", "table", "bucket"]
    sizes = slots.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    chunks = F.ceil(F.col("n") / F.lit(float(block))).cast("long")
    tasks = (slots.join(sizes, place)
             .select("cid", *place, chunks.alias("chunks"), F.pmod(F.xxhash64(F.lit(seed), "cid"), chunks).alias("chunk"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
             .select("cid", *place, "chunk",
                     (F.least("chunk", "other") * F.lit(1 << 20) + F.greatest("chunk", "other")).alias("partner")))
    dealt = (tasks.join(sigs, "cid").repartition(*place, "partner")
             .sortWithinPartitions(*place, "partner", "cid"))
    found = scratch.cut(dealt.select("cid", "copies", "unit", "sig", "table", "bucket", "chunk", "partner")
                        .mapInArrow(_links(cosine, probes), "cid long, found long, root long"), "vector-links")
    counts = found.groupBy("cid").agg(F.sum("found").alias("found"))
    labels = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), scratch, "vector-edges")
    of = (classes.select("cid", "h1", "h2", "first_id", "copies").join(counts, "cid", "left")
          .join(labels.withColumnRenamed("node", "cid"), "cid", "left")
          .withColumn("root", F.coalesce("component", "cid")))
    least = of.groupBy("root").agg(F.min("first_id").alias("component_id"))
    result = of.join(least, "root").select(
        F.col("h1").alias("__h1"), F.col("h2").alias("__h2"),
        (F.col("copies") - 1 + F.coalesce("found", F.lit(0))).alias("n_links"), "component_id")
    slim = keyed.select("vec_id", "h1", "h2")
    return (slim.join(result, (slim.h1 == F.col("__h1")) & (slim.h2 == F.col("__h2")), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id")))
