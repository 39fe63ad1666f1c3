import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gocledger.llm import topk
from gocledger.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, every=50):
    """All pairs in Python integers."""
    sound = [(i, vid, [math.floor(256 * x) for x in e]) for i, (vid, e) in enumerate(rows)
             if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, q, a in sound:
        if q is None or q % every:
            continue
        found = [(-sum(x * y for x, y in zip(a, b)), v is None, v or 0, v) for j, v, b in sound if j != i and len(a) == len(b)]
        found.sort(key=lambda t: t[:3])
        out += [(q, r + 1, t[3], -t[0]) for r, t in enumerate(found[:k])]
    return sorted(out, key=str)


def run(spark, rows, k=5, every=50, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = topk.top_k(df, F.col("vec_id") % every == 0, Scratch(spark), k=k, **kw)
    return sorted([(r.query_id, r["rank"], r.vec_id, r.score) for r in out.collect()], key=str)


def f32(x):
    return [float(v) for v in np.asarray(x, np.float32)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    low = rng.standard_normal((6, 24))                      # most of the length in a few directions
    rows = [(i, f32(rng.standard_normal(6) @ low * rng.lognormal(0, 1) + 0.1 * rng.standard_normal(24))) for i in range(700)]
    assert run(spark, rows, every=7) == brute(rows, 5, 7)


def test_small_blocks_and_seeds_give_the_same(spark):
    rng = np.random.default_rng(3)
    rows = [(i, f32(rng.standard_normal(8) * rng.lognormal())) for i in range(400)]
    want = brute(rows, 3, 4)
    assert run(spark, rows, k=3, every=4, block_bytes=600, seed_rows=4) == want
    assert run(spark, rows, k=3, every=4) == want


def test_ties_repeated_rows_and_fewer_than_k(spark):
    rows = [(i, [0.5, 0.25]) for i in range(120)] + [(50, [0.5, 0.25]), (None, [0.5, 0.25])]
    got = run(spark, rows)
    assert got == brute(rows, 5)
    assert [r[2] for r in got if r[0] == 0] == [1, 2, 3, 4, 5]
    few = [(0, [1.0]), (1, [2.0]), (None, [2.0])]
    assert run(spark, few) == brute(few, 5) and len(brute(few, 5)) == 2


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.1, 0.2]), (1, None), (2, []), (50, []), (3, [0.0, 0.0]), (100, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (150, None), (200, [nan, 0.0]), (7, [-0.3, 0.001]), (8, [0.1, 0.2, 0.3]), (250, [0.5, 0.5, 0.5]),
            (None, [0.2, 0.2])]
    assert run(spark, rows) == brute(rows, 5)


def test_large_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, f32([rng.uniform(-1, 1) * 2.0 ** rng.randrange(18, 23) for _ in range(5)])) for i in range(60)]
    assert run(spark, rows, every=10) == brute(rows, 5, 10)
    far = [(0, [1e30, 1.0]), (1, [1e30, 1.0]), (2, [-1e30, 0.0])]
    assert run(spark, far) == [(0, 1, 1, 2 ** 63 - 1), (0, 2, 2, -2 ** 63)]


def test_third_of_rows_equal_spreads_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK_ROWS", 64)
    rng = np.random.default_rng(5)
    rows = [(i, f32(rng.standard_normal(4))) for i in range(600)] + [(1000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(300)]
    scratch = Scratch(spark)
    out = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, scratch)
    got = sorted([(r.query_id, r["rank"], r.vec_id, r.score) for r in out.collect()], key=str)
    assert got == brute(rows, 5)
    sizes = [r["count"] for r in spark.read.parquet(scratch.paths[0]).groupBy("chunk").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 300


def test_bounds_skip_short_vectors(spark):
    """A query that the longest vectors answer meets only their chunk."""
    rng = np.random.default_rng(6)
    long = [(i, f32(np.abs(rng.standard_normal(4)) * 100)) for i in range(100)]
    short = [(1000 + i, f32(rng.standard_normal(4) * 0.1)) for i in range(9000)]
    scratch = Scratch(spark)
    rows = long + short
    out = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, scratch, seed_rows=64)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in out.orderBy("rank").collect()]
    assert got == [t for t in brute([long[0], *[(v, e) for v, e in rows[1:] if v]], 5, 10 ** 9)]
    tasks = spark.read.parquet(scratch.paths[-1])
    assert tasks.count() == 1 and spark.read.parquet(scratch.paths[0]).select("chunk").distinct().count() >= 4


def test_empty_and_clashing_columns(spark):
    assert topk.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0, Scratch(spark)).collect() == []
    rows = [(i, [float(i), 1.0]) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "7 as rank", "'x' as score", "1 as query", "2 as chunk", "3 as rid", "0 as norm")
    out = topk.top_k(df, F.col("vec_id") % 50 == 0, Scratch(spark))
    assert sorted([(r.query_id, r["rank"], r.vec_id, r.score) for r in out.collect()], key=str) == brute(rows, 5)
    named = df.selectExpr("concat('v', vec_id) as vec_id", "embedding")
    got = topk.top_k(named, F.col("vec_id") == "v0", Scratch(spark), k=2).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [("v1", 65536), ("v10", 65536)]
