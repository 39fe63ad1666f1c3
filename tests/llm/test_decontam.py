import random
import re

import pytest

from gocledger.llm import decontam, queries
from gocledger.llm.common import Scratch
from corpus_helpers import docs, empty, odd_rows, prose

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(t):
    return WORDS.findall((t or "").encode().lower())


def brute(rows, items, window=10):
    """per row: (n_words, hit word numbers, items)"""
    wins = {}
    for name, t in items:
        w = words(t)
        if w:
            k = min(window, len(w))
            for i in range(len(w) - k + 1):
                wins.setdefault(tuple(w[i:i + k]), set()).add(name)
    out = []
    for r in rows:
        w, hit, names = words(r[1]), set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in wins:
                    hit.update(range(i, i + k))
                    names |= {str(x) for x in wins[tuple(w[i:i + k])] if x is not None}
        out.append((len(w), hit, names))
    return out


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_bytes,shard_words", [(1 << 20, 1 << 20), (300, 40)])
def test_matches_brute_force(spark, block_bytes, shard_words):
    rng = random.Random(4)
    items = [(i, prose(i, rng.randrange(1, 60), 30)) for i in range(30)] + [(7, prose(7, 25, 30)), (None, prose(50, 14, 30)),
                                                                         (90, None), (91, "..."), (92, "w1x1 w1x1 w1x1")]
    rows = []
    for i in range(80):
        t = prose(1000 + i, rng.randrange(0, 200), 30).split()
        if i % 3 == 0:
            t[len(t) // 2:len(t) // 2] = (items[rng.randrange(30)][1] or "").upper().split()
        rows.append((i, " ".join(t)))
    rows += odd_rows()
    out = decontam.annotate(docs(spark, rows).coalesce(2), bench(spark, items), Scratch(spark), block_bytes=block_bytes,
                            shard_words=shard_words).collect()
    want = brute(rows, items)
    assert sorted((r.n_words, sum(e - s for s, e in zip(r.hit_starts, r.hit_ends)), tuple(r.item_ids), str(r.text)) for r in out) == \
        sorted((n, len(h), tuple(sorted(i)), str(r[1])) for (n, h, i), r in zip(want, rows))
    for r in out:
        assert all(a < b for a, b in zip(r.hit_starts, r.hit_ends)) and all(a < b for a, b in zip(r.hit_ends, r.hit_starts[1:]))


def test_longest_match_runs_past_the_window(spark):
    item = prose(3, 40)
    df = docs(spark, [(1, "before " + item + " after"), (2, " ".join(item.split()[5:20])), (3, "nothing here")])
    got = {r.doc_id: r.longest_match for r in decontam.annotate(df, bench(spark, [(1, item)]), Scratch(spark)).collect()}
    assert got == {1: 40, 2: 15, 3: 0}


def test_removal_keeps_clean_rows_and_columns(spark):
    item = prose(3, 40)
    df = docs(spark, [(1, "x " + item), (2, "clean"), (2, "clean"), (None, None), (4, "")]).selectExpr("*", "5 as n_words", "'k' as item_ids")
    kept = decontam.remove_contaminated(df, bench(spark, [(1, item)]), Scratch(spark))
    assert kept.columns == df.columns
    rows = kept.collect()
    assert sorted(str(r.doc_id) for r in rows) == ["2", "2", "4", "None"] and {(r.n_words, r.item_ids) for r in rows} == {(5, "k")}


def test_empty_tables(spark):
    assert decontam.annotate(empty(spark), bench(spark, [(1, "a b")]), Scratch(spark)).count() == 0
    none = decontam.annotate(docs(spark, [(1, "a b")]), bench(spark, []), Scratch(spark)).collect()
    assert [(r.n_words, r.hit_starts, r.item_ids, r.longest_match) for r in none] == [(2, [], [], 0)]


def test_repeated_words_in_items_and_documents(spark):
    rows, items = [(1, "a " * 300), (2, "a " * 9), (3, "b " + "a " * 12 + "c")], [(1, "a " * 30), (2, "a " * 11 + "c")]
    out = sorted(decontam.annotate(docs(spark, rows), bench(spark, items), Scratch(spark)).collect(), key=lambda r: r.doc_id)
    want = brute(rows, items)
    assert [(sum(e - s for s, e in zip(r.hit_starts, r.hit_ends)), set(r.item_ids)) for r in out] == [(len(h), i) for _, h, i in want]


def brute_longest(text, items):
    """Longest verbatim match of a text with an item, where it reaches a window."""
    w, best = words(text), 0
    for _, t in items:
        x = words(t)
        for i in range(len(w)):
            for j in range(len(x)):
                n = 0
                while i + n < len(w) and j + n < len(x) and w[i + n] == x[j + n]:
                    n += 1
                best = max(best, n)
    return best


@pytest.mark.parametrize("block_bytes,shard_words", [(1 << 20, 1 << 18), (150, 60)])
def test_longest_matches_match_brute_force(spark, block_bytes, shard_words):
    rng = random.Random(11)
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(10, 40)))) for i in range(8)]
    rows = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randrange(0, 60)))) for i in range(40)]
    rows += [(100 + i, rows[i][1] + " " + items[i % 8][1][:30] + " " + rows[i][1]) for i in range(10)]
    out = decontam.annotate(docs(spark, rows), bench(spark, items), Scratch(spark), block_bytes=block_bytes, shard_words=shard_words).collect()
    got = {r.doc_id: r for r in out}
    for (d, t), (n, hit, names) in zip(rows, brute(rows, items)):
        assert {w for s, e in zip(got[d].hit_starts, got[d].hit_ends) for w in range(s, e)} == hit and set(got[d].item_ids) == names
        longest = brute_longest(t, items)
        assert got[d].longest_match == (longest if longest >= 10 else 0)


def test_equal_words_take_linear_places():
    """4,000 equal words against 4,000: one window group, one range."""
    import time

    import numpy as np
    test = decontam.TestIndex([("x", "a " * 4000)], 10)
    start = time.perf_counter()
    place, size, longest, of, item = decontam.find_matches(np.append(np.ones(4000, np.int32), 0), test)
    assert time.perf_counter() - start < 1
    assert sorted(place.tolist()) == list(range(3991)) and longest.max() == 4000 and len(of) == 1 and item.tolist() == [0]


def test_large_block_and_small_shard():
    """A benchmark block of 16 MB: a shard costs by its own words, and little memory beside the index."""
    import time
    import tracemalloc

    import numpy as np
    rng = np.random.default_rng(2)
    names = np.array([f"w{i}" for i in range(60_000)])
    items = [(str(i), " ".join(names[rng.integers(0, len(names), 4000)])) for i in range(600)]
    assert sum(len(t) for _, t in items) > 15 << 20
    test = decontam.TestIndex(items, 10)
    taken = np.array([test.words[w.encode()] for w in items[5][1].split()[100:150]], np.int32)
    shard = np.concatenate([rng.integers(0, len(names), 2000).astype(np.int32), [0], taken, [0]])
    tracemalloc.start()
    start = time.perf_counter()
    place, size, longest, of, item = decontam.find_matches(shard, test)
    took, peak = time.perf_counter() - start, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(place) == 41 and longest.max() == 50 and set(item.tolist()) == {5}
    assert took < 1 and peak < 100 << 20
    held = sum(a.nbytes for a in (test.ids, test.need, test.item, test.pairs, test.pair_at, test.pair_from))
    assert held < 120 << 20


def test_shard_spans_batches(spark):
    """A shard is bounded by words, not by what an Arrow batch holds."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    item = prose(3, 40)
    rows = [(i, ("x " + item) if i % 7 == 0 else prose(100 + i, 30)) for i in range(60)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        out = decontam.annotate(docs(spark, rows).coalesce(1), bench(spark, [(1, item)]), Scratch(spark)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert [(r.doc_id, r.longest_match) for r in out] == [(i, 40 if i % 7 == 0 else 0) for i in range(60)]


def test_query_matches_its_sql(spark):
    from compare_oracle import compare
    assert compare(spark, "/root/testdata/sf0.001", ["op10_decontamination"], verbose=False)["op10_decontamination"][0] == "ok"
    assert queries.op10_decontamination(spark, "/root/testdata/sf0.001").columns[0] == "doc_id"
