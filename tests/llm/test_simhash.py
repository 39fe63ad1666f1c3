import random

import numpy as np
import xxhash

from gocledger.llm import simhash
from gocledger.llm.common import Scratch
from corpus_helpers import docs, empty, odd_rows, prose


def brute_fingerprint(text):
    words = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """component by doc index, from all pairs"""
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= 4:
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_is_the_contract():
    for t in ["", None, "one", "One TWO three", "a b c d e f g h", prose(3, 500), "x\x0by\x0cz w v ÄB q", "  lead and trail  "]:
        assert simhash.fingerprint(t) & (2**64 - 1) == brute_fingerprint(t), t


def test_fingerprint_of_a_text_longer_than_a_piece():
    text = prose(5, 250_000)
    assert len(text) > 1 << 20
    assert simhash.fingerprint(text) & (2**64 - 1) == brute_fingerprint(text)


def test_forest_finds_all_links_between_fingerprints(spark):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(40)]
    bits = set(base)
    for b in base:
        for _ in range(rng.randrange(12)):
            for k in rng.sample(range(64), rng.randrange(1, 8)):
                b ^= 1 << k
            bits.add(b)
    bits = sorted(bits)
    df = spark.createDataFrame([(signed(b),) for b in bits], "bits long")
    want = brute_components(bits)
    for shard_rows in (4096, 3):  # 3: every bucket is cut into chunks that must still all meet
        edges = simhash.links_forest(df, 4, shard_rows).collect()
        label = list(range(len(bits)))
        at = {signed(b): i for i, b in enumerate(bits)}
        for e in edges:
            assert bin((e.a ^ e.b) & (2**64 - 1)).count("1") <= 4 * len(bits)
            x, y = at[e.a], at[e.b]
            x, y = label[x], label[y]
            label = [min(x, y) if v in (x, y) else v for v in label]
        assert label == want, shard_rows


def test_bk_forest_within_equals_all_pairs():
    rng = np.random.default_rng(1)
    fp = np.unique(rng.integers(0, 1 << 12, 600, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15 % (1 << 40)))
    group = np.sort(rng.integers(0, 5, len(fp)))
    forest = simhash.BKForest(fp, group, np.arange(len(fp)))
    q = np.arange(len(fp))
    got = {(a, b) for x, y in forest.within(q, forest.lead[group], 6) for a, b in zip(x.tolist(), y.tolist())}
    d = np.bitwise_count(fp[:, None] ^ fp[None, :])
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero((d <= 6) & (group[:, None] == group[None, :])))}
    assert got == want


def test_groups_match_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        t = prose(i, 120).split()
        rows.append((100 - i, " ".join(t)))
        for c in range(i % 4):
            u = list(t)
            u[rng.randrange(len(u))] = "changed"
            rows.append((1000 + 10 * i + c, " ".join(u) if c else " ".join(t)))
    rng.shuffle(rows)
    got = {r.doc_id: (r.fingerprint_bits, r.component_id) for r in simhash.simhash_groups(docs(spark, rows), Scratch(spark)).collect()}
    prints = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(prints)
    least = {}
    for (i, _), c in zip(rows, comp):
        least[c] = min(least.get(c, 1 << 60), i)
    assert got == {i: (signed(p), least[c]) for (i, _), p, c in zip(rows, prints, comp)}
    assert len(set(least.values())) < len(rows)


def test_odd_rows(spark):
    rows = odd_rows()
    out = simhash.simhash_groups(docs(spark, rows), Scratch(spark)).collect()
    assert len(out) == len(rows)
    zero = [r for r in out if r.fingerprint_bits == 0]
    assert {r.doc_id for r in zero} >= {None, 2, 3, 4} and {r.component_id for r in zero} == {2}
    kept = simhash.keep_one_per_group(docs(spark, rows), Scratch(spark))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 2, 5, 6, 8] and ids.count(None) == 1


def test_empty_and_clashing_columns(spark):
    assert simhash.simhash_groups(empty(spark), Scratch(spark)).count() == 0
    assert simhash.keep_one_per_group(empty(spark), Scratch(spark)).count() == 0
    clash = docs(spark, [(1, "a b c d"), (2, "a b c d")]).selectExpr("*", "7 as bits", "8 as fingerprint_bits", "9 as component_id", "1 as root")
    kept = simhash.keep_one_per_group(clash, Scratch(spark)).collect()
    assert [(r.doc_id, r.bits, r.fingerprint_bits) for r in kept] == [(1, 7, 8)]
