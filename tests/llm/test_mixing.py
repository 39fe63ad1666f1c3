import re

from gocledger.llm import mixing
from gocledger.llm.common import Scratch
from corpus_helpers import docs, empty, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    """Deal by weight, stop at most times the size, deal the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, live = dict.fromkeys(names, 0.0), share * sum(sizes.values()), list(names)
    while left > 1e-9 and live:
        total = sum(w[s] for s in live)
        give = {s: left * w[s] / total for s in live}
        left = 0.0
        for s in live:
            target[s] += give[s]
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
        live = [s for s in live if target[s] < most * sizes[s]]
    return target


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def check(plan, rows, all_rows):
    sizes = {}
    for r in all_rows:
        sizes[r[3] if len(r) > 3 else "s"] = sizes.get(r[3] if len(r) > 3 else "s", 0) + len(WORD.findall(r[1] or ""))
    want = brute_targets(sizes)
    for p in plan:
        assert p.source_size == sizes[p.source] and abs(p.target - want[p.source]) < 1e-6
        assert p.target <= 2 * p.source_size + 1e-6
        own = [r for r in rows if r.source == p.source]
        taken = sum(r.copies * r["size"] for r in own)
        assert abs(taken - p.target) <= max((r["size"] for r in own), default=0)
        whole = int(p.target // p.source_size) if p.source_size else 0
        assert {r.copies for r in own} <= {whole, whole + 1}            # complete epochs first
        inside = [r.key for r in own if r.copies > whole]
        outside = [r.key for r in own if r.copies == whole]
        assert not inside or not outside or max(inside) <= min(outside)  # a prefix of the key order
    return want


def test_targets_and_prefixes(spark):
    rows = [(i, prose(i, 5 + i * 7 % 90), "en", f"src{i % 7}" if i % 11 else None) for i in range(400)]
    rows += [(1000 + i, prose(i, 300), "en", "big") for i in range(80)]
    df = docs(spark, rows)
    plan, out = mixing.mix(df, labels(spark, [(i, i % 2, 0) for i in range(300)]), Scratch(spark))
    check(plan.collect(), out.collect(), rows)
    _, again = mixing.mix(df.repartition(7), labels(spark, [(i, i % 2, 0) for i in range(300)]), Scratch(spark))
    key = lambda r: (r.doc_id, r.copies, r["size"])
    assert sorted(map(key, out.collect())) == sorted(map(key, again.collect()))


def test_quality_weights_prefer_good_documents(spark):
    rows = [(i, "one two three four", "en", "a" if i < 2000 else "z") for i in range(4000)]
    df, lab = docs(spark, rows), labels(spark, [(i, i % 2, 0) for i in range(4000)])
    _, out = mixing.mix(df, lab, Scratch(spark), share=0.5)
    got = [r for r in out.collect() if r.source == "z"]
    good, bad = (sum(r.copies for r in got if r.doc_id % 2 == q) for q in (1, 0))
    assert good > 1.8 * bad > 0


def test_apply_mix_repeats_documents(spark):
    rows = [(i, prose(i, 40), "en", f"s{i % 4}") for i in range(200)]
    df, lab = docs(spark, rows).selectExpr("*", "1 as epochs", "2 as size"), labels(spark)
    _, out = mixing.mix(df, lab, Scratch(spark))
    want = {r.doc_id: r.copies for r in out.collect() if r.copies}
    mixed = mixing.apply_mix(df, lab, Scratch(spark))
    assert mixed.columns == df.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want


def test_odd_rows_and_empty_tables(spark):
    rows = odd_rows()
    plan, out = mixing.mix(docs(spark, rows), labels(spark, [(1, 1, 0), (1, None, 0), (None, 1, 1), (5, 0, 0)]), Scratch(spark))
    assert out.count() == len(rows)
    sized = {r.source: r.source_size for r in plan.collect()}
    assert set(sized) == {"s", None}
    for r in out.collect():
        assert r.copies <= 2
    assert {r["size"] for r in out.where("doc_id in (2, 3, 4)").collect()} == {0}
    same = [r.copies for r in out.where("doc_id = 1").collect()]
    assert len(same) == 2 and len(set(same)) == 1                        # repeated rows go together
    p, o = mixing.mix(empty(spark), labels(spark), Scratch(spark))
    assert p.count() == 0 and o.count() == 0
    assert mixing.apply_mix(empty(spark), labels(spark), Scratch(spark)).count() == 0
    assert mixing.apply_mix(docs(spark, [(1, None), (2, "")]), None, Scratch(spark)).count() == 0


def test_word_count(spark):
    texts = [None, "", " ", "a", " a\tb\x0bc\x0cd\re\nf ", "no break", "x" * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(mixing.word_count(df.text)).collect()] == [len(WORD.findall(t or "")) for t in texts]


def test_query_matches_its_sql(spark):
    from compare_oracle import compare
    assert compare(spark, "/root/testdata/sf0.001", ["op8_mixing"], verbose=False)["op8_mixing"][0] == "ok"


def test_plan_is_native(spark):
    _, out = mixing.mix(docs(spark, [(1, "a b", "en", "s")]), labels(spark), Scratch(spark))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
