from pyspark.sql import functions as F

from gocledger.llm import queries, sharding
from corpus_helpers import docs, empty, odd_rows, prose


def test_law_slots_and_rows(spark):
    rows = odd_rows() + [(i, prose(i % 7, 30)) for i in range(100, 400)]
    df = docs(spark, rows)
    out = sharding.shuffle_into_shards(df, n_shards=5, bucket_bytes=2000).collect()
    assert sorted(map(str, [(r.doc_id, r.text, r.lang, r.source) for r in out])) == \
        sorted(map(str, [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]))
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) <= set(range(5)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert len({r.bucket for r in out}) > 10                       # memory-sized buckets
    shard = {}
    for r in out:
        assert shard.setdefault(r.doc_id, r.shard) == r.shard       # doc_id decides


def test_one_more_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(2000).withColumnRenamed("id", "doc_id")
    for n in (1, 2, 7, 24):
        got = ids.select(sharding.shard_of(F.col("doc_id"), n).alias("a"), sharding.shard_of(F.col("doc_id"), n + 1).alias("b")).collect()
        assert all(r.a == r.b or r.b == n for r in got) and any(r.b == n for r in got)
        assert all(0 <= r.a < n for r in got)


def test_hot_text_and_repeated_rows_spread_over_buckets(spark):
    rows = [(7, "same text")] * 600 + [(i, "same text") for i in range(600)]
    out = sharding.shuffle_into_shards(docs(spark, rows), n_shards=2, bucket_bytes=1000)
    sizes = [r["count"] for r in out.groupBy("shard", "bucket").count().collect()]
    assert sum(sizes) == 1200 and max(sizes) < 300


def test_fisher_yates_moves_rows_and_repeats(spark):
    df = docs(spark, [(i, f"text {i}") for i in range(500)]).coalesce(1)
    one = [r.doc_id for r in sharding.shuffle_into_shards(df, n_shards=1).orderBy("slot").collect()]
    two = [r.doc_id for r in sharding.shuffle_into_shards(df, n_shards=1).orderBy("slot").collect()]
    other = [r.doc_id for r in sharding.shuffle_into_shards(df, n_shards=1, seed=3).orderBy("slot").collect()]
    assert one == two and one != other and sorted(one) == list(range(500)) and one != sorted(one)


def test_empty_clash_and_write(spark, tmp_path):
    assert sharding.shuffle_into_shards(empty(spark)).count() == 0
    df = docs(spark, [(i, f"t{i}") for i in range(50)]).selectExpr("*", "1 as shard", "'x' as Slot", "2 as other")
    out = sharding.shuffle_into_shards(df, n_shards=3)
    assert [c for c in out.columns if c.lower() in ("shard", "slot", "other")] == ["other", "shard", "slot"]
    sharding.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 50 and {r.shard for r in back.select("shard").distinct().collect()} <= {0, 1, 2}


def test_query_digest(spark):
    import zlib
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = queries.op2_sharding(spark, sf).collect()
    assert {r.doc_id for r in out} == set(text) and len(out) == len(text)
    for r in out:
        data = (text[r.doc_id] or "").encode()
        assert r.size == len(data) + 8 and r.text_crc32 == zlib.crc32(data) and r.law == "key"
        assert r.grown_shard in (r.shard, 24)
