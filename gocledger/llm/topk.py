"""Exact top-k search by inner product: vectors in order of length, partial sums after an SVD rotation.

Components become integers first (floor(scale * x)), so that scores are exact.
All vectors are written once, sorted by descending length (norm) and cut into
ranges (``chunk``).  By Cauchy-Schwarz no vector of length n scores above
``|q| * n``; a query whose k-th best score so far is s therefore needs no vector
shorter than ``s / |q|``.  Every query gets its first bound from the ``seeds``
longest vectors (a broadcast of bounded size); queries are then sorted by the
length they still need and cut into blocks, and a block meets the chunks from the
longest vector down to that length, no others.  Each (block, chunk) is a task's
group: it keeps the block's queries in memory and streams the chunk, so a chunk
may be of any size and a block has at most ``block_bytes``.

Within a task vectors come in tiles.  Rotated by the right singular vectors of a
sample (which gather the length in the first coordinates), a tile is multiplied a
few coordinates at a time; after each step a pair goes on only if its partial sum
plus the product of both remaining lengths can still reach the query's k-th best.
What remains is scored in integers, ties to the smaller id, and tightens the
bounds for the next tile.  The rotation is fitted on at most ``FIT_ROWS`` rows
(a documented sample): it decides how early a pair is dropped, never whether.

A task returns at most k rows per query; a window over those gives the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from gocledger.llm.common import Scratch, pa_type

K = 5
SCALE = 256
#: Rows that the rotation is fitted on: those with the smallest hash of their number.
FIT_ROWS = 4096
#: Longest vectors that give every query its first bound, and their bytes at most.
SEED_ROWS = 4096
SEED_BYTES = 32 << 20
#: Bytes of integer components in a block of queries.
BLOCK_BYTES = 16 << 20
#: A chunk's rows at least and bytes wanted; chunks at most (their lengths are a broadcast).
CHUNK_ROWS, CHUNK_BYTES, MAX_CHUNKS = 2048, 128 << 20, 1 << 16
#: Vectors and queries multiplied at once.
TILE, QUERY_TILE = 1024, 512
#: Rotated coordinates kept at most; the others stand in the remaining length.
MAX_ROTATED = 256
#: Relative slack of bounds, far above the rounding of sums in double precision.
_SLACK = 1e-9


class Rotation:
    """Right singular vectors for vectors of one length (none: the first coordinates as they are)."""

    def __init__(self, sample: np.ndarray | None, dims: int) -> None:
        keep = min(dims, MAX_ROTATED)
        if sample is None or len(sample) < 2 or not np.isfinite(sample).all() or not sample.any():
            self.basis = np.eye(dims, keep)
        else:
            self.basis = np.linalg.svd(sample / np.abs(sample).max(), full_matrices=True)[2][:keep].T.copy()
        self.steps = sorted({max(1, keep * p // 8) for p in (1, 2, 4, 6)} | {keep}) if dims else []

    def turned(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rotated coordinates, and the remaining length behind each step."""
        y = x @ self.basis
        whole = np.einsum("ij,ij->i", x, x)
        left = [np.sqrt(np.maximum(whole - np.einsum("ij,ij->i", y[:, :s], y[:, :s]), 0.0)) for s in self.steps]
        return y, np.array(left).reshape(len(self.steps), len(x))


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products of integer vectors, exactly; beyond a long: its ends."""
    if a.size == 0:
        return np.zeros(len(a), np.int64)
    if float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * a.shape[1] < 2.0 ** 53:
        return np.einsum("ij,ij->i", a.astype(np.float64), b.astype(np.float64)).astype(np.int64)
    top = (1 << 63) - 1
    return np.array([max(-top - 1, min(top, sum(x * y for x, y in zip(p, q)))) for p, q in zip(a.tolist(), b.tolist())], np.int64)


class Block:
    """Queries of one length with their best k so far."""

    def __init__(self, x: np.ndarray, rids: np.ndarray, bound: np.ndarray, rotation: Rotation, k: int, id_type: pa.DataType) -> None:
        self.x, self.rids, self.k = x, rids, k
        self.bound = bound.astype(np.float64).copy()
        self.rotation = rotation
        self.y, self.left = rotation.turned(x.astype(np.float64))
        self.norm = np.sqrt(np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64)))
        self.best = pa.table({"q": pa.array([], pa.int64()), "score": pa.array([], pa.int64()),
                              "id": pa.array([], id_type), "rid": pa.array([], pa.int64())})

    def offer(self, x: np.ndarray, norm: np.ndarray, rids: np.ndarray, ids: pa.Array) -> None:
        """A tile of vectors, exactly: afterwards ``best`` and ``bound`` take them into account."""
        y, left = self.rotation.turned(x.astype(np.float64))
        found = []
        for at in range(0, len(self.x), QUERY_TILE):
            rows = slice(at, at + QUERY_TILE)
            slack = _SLACK * self.norm[rows, None] * norm[None, :] + 1e-6
            alive = ~(self.norm[rows, None] * norm[None, :] + slack < self.bound[rows, None])
            alive &= self.rids[rows, None] != rids[None, :]
            q, v = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            part = np.zeros((len(q), len(v)))
            before = 0
            for s, step in enumerate(self.rotation.steps):
                if not len(q) or not len(v):
                    break
                part += self.y[rows][q, before:step] @ y[v, before:step].T
                before = step
                reach = part + self.left[s][rows][q][:, None] * left[s][v][None, :]
                alive[np.ix_(q, v)] &= ~(reach + slack[np.ix_(q, v)] < self.bound[rows][q][:, None])
                stay_q, stay_v = alive[np.ix_(q, v)].any(axis=1), alive[np.ix_(q, v)].any(axis=0)
                part = part[np.ix_(stay_q, stay_v)]
                q, v = q[stay_q], v[stay_v]
            i, j = np.nonzero(alive[np.ix_(q, v)])
            found.append((q[i] + at, v[j]))
        q, v = (np.concatenate(c) for c in zip(*found))
        for at in range(0, len(q), 1 << 16):
            i, j = q[at:at + (1 << 16)], v[at:at + (1 << 16)]
            self._keep(i, exact_scores(self.x[i], x[j]), ids.take(pa.array(j)), rids[j])

    def _keep(self, q: np.ndarray, score: np.ndarray, ids: pa.Array, rids: np.ndarray) -> None:
        fit = np.flatnonzero(~(score < self.bound[q]))
        if not len(fit):
            return
        more = pa.table({"q": pa.array(q[fit]), "score": pa.array(score[fit]), "id": ids.take(pa.array(fit)),
                         "rid": pa.array(rids[fit])}).cast(self.best.schema)
        both = pa.concat_tables([self.best, more]).combine_chunks()
        both = both.take(pc.sort_indices(both, sort_keys=[("q", "ascending"), ("score", "descending"), ("id", "ascending"), ("rid", "ascending")]))
        at = both["q"].to_numpy()
        start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        rank = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
        self.best = both.take(pa.array(np.flatnonzero(rank < self.k)))
        full = rank == self.k - 1
        self.bound[at[full]] = np.maximum(self.bound[at[full]], both["score"].to_numpy()[full])


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Components end to end, and where each vector starts (one more entry at the end)."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat, np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))]).astype(np.int64)


def _by_length(flat: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) of the chosen rows, for each length."""
    dims = np.diff(starts)[rows]
    for d in np.unique(dims).tolist():
        of = rows[dims == d]
        yield d, of, flat[starts[of][:, None] + np.arange(d)[None, :]].reshape(len(of), d)


def _first_bounds(seeds: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """Per query the k-th best score among the seeds of its length, and the length it needs at least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
            rids, norm = col["rid"].to_numpy(), col["norm"].to_numpy()
            bound = np.full(len(batch), -np.inf)
            flat, starts = _vectors(col["ints"])
            for d, rows, x in _by_length(flat, starts, np.arange(len(batch))):
                if d not in seeds:
                    continue
                other, of = seeds[d]
                for at in range(0, len(rows), QUERY_TILE):
                    some = rows[at:at + QUERY_TILE]
                    got = x[at:at + QUERY_TILE].astype(np.float64) @ other.astype(np.float64).T
                    # Rounded sums: a little less than the score is a bound as well.
                    got -= _SLACK * np.abs(norm[some][:, None]) * np.sqrt((other.astype(np.float64) ** 2).sum(axis=1))[None, :]
                    got[rids[some][:, None] == of[None, :]] = -np.inf
                    if got.shape[1] >= k:
                        bound[some] = np.partition(got, got.shape[1] - k, axis=1)[:, got.shape[1] - k]
            bound = np.where(np.isnan(bound), -np.inf, bound)
            with np.errstate(divide="ignore", invalid="ignore"):
                needs = np.where(norm > 0, bound / norm, -np.inf) * (1 - np.sign(bound) * 1e-9)
            yield pa.RecordBatch.from_arrays(
                [col["rid"], col["vec_id"], col["ints"], pa.array(bound), pa.array(np.where(np.isnan(needs), -np.inf, needs))],
                names=["rid", "vec_id", "ints", "bound", "needs"])

    return run


def _search(rotations: dict[int, Rotation], k: int, id_type: pa.DataType):
    """mapInArrow function over rows sorted by (block, chunk, queries first, length descending)."""
    names = ["query_rid", "score", "vec_id", "rid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = None
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        blocks: dict[int, Block] = {}

        def result() -> Iterator[pa.RecordBatch]:
            for b in blocks.values():
                t = b.best
                if len(t):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(b.rids[t["q"].to_numpy()]), *(t[n].combine_chunks() for n in ("score", "id", "rid"))], names=names)

        def build() -> None:
            """The queries gathered so far, by length, become blocks."""
            for d in {x.shape[1] for x, _, _ in waiting}:
                of = [w for w in waiting if w[0].shape[1] == d]
                x, rids, bound = (np.concatenate(c) for c in zip(*of))
                blocks[d] = Block(x, rids, bound, rotations.get(d) or Rotation(None, d), k, id_type)
            waiting.clear()

        for batch in batches:
            col = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
            block, chunk = col["block"].to_numpy(), col["chunk"].to_numpy()
            flat, starts = _vectors(col["ints"])
            rids, norm, query = col["rid"].to_numpy(), col["norm"].to_numpy(), col["query"].to_numpy(zero_copy_only=False)
            bound = col["bound"].to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((block[1:] != block[:-1]) | (chunk[1:] != chunk[:-1]) | (query[1:] != query[:-1])) + 1
            for at, end in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)]):
                if (key := (int(block[at]), int(chunk[at]))) != task:
                    yield from result()
                    blocks.clear()
                    waiting.clear()
                    task = key
                if query[at]:
                    waiting += [(x, rids[of], bound[of]) for _, of, x in _by_length(flat, starts, np.arange(at, end))]
                    continue
                if waiting:
                    build()
                for tile in range(at, end, TILE):
                    for d, of, x in _by_length(flat, starts, np.arange(tile, min(end, tile + TILE))):
                        if d in blocks:
                            blocks[d].offer(x, norm[of], rids[of], col["vec_id"].take(pa.array(of)))
        yield from result()

    return run


def _chunks(n: int, size: int) -> int:
    return max(1, min(MAX_CHUNKS, max(math.ceil(size / CHUNK_BYTES), min(64, math.ceil(n / CHUNK_ROWS)))))


def top_k(vectors: DataFrame, is_query: Column, scratch: Scratch, *, k: int = K, scale: int = SCALE,
          vec_id: str = "vec_id", embedding: str = "embedding", block_bytes: int = BLOCK_BYTES,
          seed_rows: int = SEED_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every row where ``is_query`` holds the ``k`` other
    rows with the highest inner product of integer components, all where there are fewer.

    Ties go to the smaller vec_id, a null vec_id last.  Rows are told apart by
    themselves, not by vec_id: of two rows with one vec_id each is a candidate for the
    other.  Null vectors and vectors with null or non-finite components take no part;
    zero vectors do (they score 0); vectors of different lengths do not meet, empty ones
    score 0 with each other.  Components stop at the ends of a long, and so do scores.
    No rows or no queries: no rows.
    """
    v = F.col(embedding)
    sound = F.coalesce(v.isNotNull() & ~F.exists(
        v, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True))), F.lit(False))
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    square = F.aggregate("ints", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = (vectors.select(F.col(vec_id).alias("vec_id"), v.alias(embedding), F.coalesce(is_query, F.lit(False)).alias("query"))
            .where(sound).select("vec_id", "query", ints.alias("ints")))
    n, n_queries, size, longest = rows.agg(
        F.count(F.lit(1)), F.count_if("query"), F.sum(F.size("ints") * 8), F.max(F.size("ints"))).first()
    key = rows.schema["vec_id"].dataType
    result = T.StructType([T.StructField("query_id", key), T.StructField("rank", T.IntegerType()),
                           T.StructField("vec_id", key), T.StructField("score", T.LongType())])
    if not n_queries:
        return vectors.sparkSession.createDataFrame([], result)
    spread = F.xxhash64("ints", "vec_id")
    table = scratch.cut(
        rows.withColumn("norm", F.sqrt(square)).repartitionByRange(_chunks(n, size), F.desc("norm"), spread)
        .sortWithinPartitions(F.desc("norm"), spread)
        .select("*", F.spark_partition_id().alias("chunk"), F.monotonically_increasing_id().alias("rid")), "topk-vectors")

    sample = table.orderBy(F.xxhash64("rid")).limit(min(FIT_ROWS, max(2, SEED_BYTES // (8 * max(1, longest))))).select("ints").toArrow()
    rotations = {d: Rotation(x.astype(np.float64), d)
                 for d, _, x in _by_length(*_vectors(sample["ints"].combine_chunks()), np.arange(len(sample)))}
    top = (table.orderBy(F.desc("norm"), "rid").limit(min(seed_rows, max(k + 1, SEED_BYTES // (8 * max(1, longest)))))
           .select("ints", "rid").toArrow())
    of_seed = top["rid"].to_numpy()
    seeds = {d: (x, of_seed[of]) for d, of, x in _by_length(*_vectors(top["ints"].combine_chunks()), np.arange(len(top)))}

    schema = T.StructType([T.StructField("rid", T.LongType()), T.StructField("vec_id", key),
                           T.StructField("ints", T.ArrayType(T.LongType())), T.StructField("bound", T.DoubleType()),
                           T.StructField("needs", T.DoubleType())])
    bounded = table.where("query").select("rid", "vec_id", "ints", "norm").mapInArrow(_first_bounds(seeds, k), schema)
    ranges = max(1, math.ceil(n_queries * longest * 8 / block_bytes))
    most = max(1, block_bytes // (8 * max(1, longest)))
    queries = scratch.cut(
        bounded.repartitionByRange(ranges, "needs", F.xxhash64("rid")).sortWithinPartitions("needs")
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "topk-queries")
    # Blocks follow a query's place in that order, not the (sampled) ranges: one row per range decides the places.
    starts = queries.groupBy("part").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("rows"))
    shift = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("start")
    queries = (queries.join(starts.select("part", shift.alias("shift")), "part")
               .withColumn("block", F.floor((F.col("at") + F.col("shift")) / most).cast("long")))

    lengths = table.groupBy("chunk").agg(F.max("norm").alias("norm"))  # at most MAX_CHUNKS rows
    pairs = scratch.cut(
        queries.groupBy("block").agg(F.min("needs").alias("needs"))
        .join(F.broadcast(lengths), ~(F.col("norm") < F.col("needs"))).select("block", "chunk"), "topk-tasks")
    asked = queries.join(pairs, "block").select(
        "block", "chunk", F.lit(True).alias("query"), "rid", "vec_id", "ints", F.lit(0.0).alias("norm"), "bound")
    offered = table.join(pairs, "chunk").select(
        "block", "chunk", F.lit(False).alias("query"), "rid", "vec_id", "ints", "norm", F.lit(0.0).alias("bound"))
    dealt = (asked.unionByName(offered).repartition("block", "chunk")
             .sortWithinPartitions("block", "chunk", F.desc("query"), F.desc("norm")))
    found = dealt.mapInArrow(
        _search(rotations, k, pa_type(key)),
        T.StructType([T.StructField("query_rid", T.LongType()), T.StructField("score", T.LongType()),
                      T.StructField("vec_id", key), T.StructField("rid", T.LongType())]))
    order = Window.partitionBy("query_rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    who = queries.select(F.col("rid").alias("query_rid"), F.col("vec_id").alias("query_id"))
    return best.join(who, "query_rid").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
