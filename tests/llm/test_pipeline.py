import corpus_pipeline
import __spark_entry__ as E
from gocledger.llm import decontam, mixing, simhash
from gocledger.llm.common import Scratch, read
from corpus_helpers import SCHEMA, odd_rows, prose

SF = "/root/testdata/sf0.001"
NAMES = ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "mixing", "sharding"]


def write(spark, folder, documents, labels, benchmark):
    spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", 1) for r in documents],
                          SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_registered_and_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    assert E.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in E.oracle_sql()


def test_stages_take_effect(spark, tmp_path):
    item = prose(500, 40)
    documents = [(i, prose(i, 50) + (" grublword vileword" if i % 5 == 0 else ""), "en", f"s{i % 3}") for i in range(300)]
    documents += [(1000 + i, prose(i, 50), "en", "s0") for i in range(1, 40) if i % 5]           # exact copies
    documents += [(2000 + i, prose(3000 + i, 20) + " " + item + " " + prose(4000 + i, 20), "en", "s1") for i in range(5)]
    folder = write(spark, tmp_path, documents, [(i, 1, int(i % 5 == 0)) for i in range(250)], [(1, item)])
    docs, ids = read(spark, folder, "documents"), {}
    for n, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        ids[n] = sorted(r.doc_id for r in rows)
    assert not set(ids["toxicity"]) & {i for i in range(0, 300, 5)} and len(ids["toxicity"]) == len(documents) - 60
    assert not [i for i in ids["simhash_near_dedup"] if 1000 <= i < 2000]                          # the smaller doc_id stays
    assert len(ids["simhash_near_dedup"]) == 240 + 5
    assert ids["benchmark_decontamination"] == [i for i in ids["simhash_near_dedup"] if i < 2000]
    assert set(ids["mixing"]) <= set(ids["benchmark_decontamination"]) and ids["mixing"] == ids["sharding"]
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    slots = {}
    for r in docs.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    docs = read(spark, SF, "documents")
    kept = corpus_pipeline.toxic_documents(spark, docs, SF)
    kept = simhash.keep_one_per_group(kept, Scratch(spark))
    kept = decontam.remove_contaminated(kept, read(spark, SF, "benchmark"), Scratch(spark))
    kept = mixing.apply_mix(kept, read(spark, SF, "labels"), Scratch(spark))
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted((r.doc_id, r.text) for r in kept.collect())


def test_odd_and_empty_documents(spark, tmp_path):
    folder = write(spark, tmp_path / "odd", odd_rows(), [(1, 1, 0), (None, 0, 1), (1, None, None)], [(1, None), (None, "a b c")])
    assert corpus_pipeline.run(spark, folder).count() >= 0
    folder = write(spark, tmp_path / "none", [], [], [])
    out = corpus_pipeline.run(spark, folder)
    assert out.count() == 0 and "shard" in out.columns
