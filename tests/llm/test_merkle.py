import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpus_helpers import docs, empty, odd_rows, prose
from gocledger.llm import merkle, queries
from gocledger.llm.common import Scratch


def h(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8")).hexdigest()


def leaf(doc_id, text, lang, source, n):
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(enc(doc_id), enc(source), enc(lang), enc(n), enc(text))


def brute(rows, fanout=8):
    """[(doc_id, leaf, subroot, root, siblings level by level)] with plain lists, one tree after another."""
    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append((r[0] is not None, r[0] or 0, leaf(*r), r))

    def climb(digests):
        paths = [[] for _ in digests]
        of = list(range(len(digests)))
        while len(digests) > 1:
            for j, at in enumerate(of):
                run = digests[at // fanout * fanout:at // fanout * fanout + fanout]
                paths[j].append((run[:at % fanout], run[at % fanout + 1:]))
            digests = [h(*digests[i:i + fanout]) for i in range(0, len(digests), fanout)]
            of = [at // fanout for at in of]
        return digests[0], paths

    order = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    low = {g: climb([x[2] for x in sorted(trees[g], key=lambda x: x[:3])]) for g in order}
    root, above = climb([low[g][0] for g in order])
    out = []
    for t, g in enumerate(order):
        for x, path in zip(sorted(trees[g], key=lambda x: x[:3]), low[g][1]):
            out.append((x[3], x[2], low[g][0], root, path + above[t]))
    return out


def folded(node, path):
    for left, right in path:
        node = h(*left, node, *right)
    return node


def full(rows):
    """corpus_helpers rows as (doc_id, text, lang, source, n_chars)."""
    return [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]


def proofs(made):
    return sorted(((r.doc_id, r.tree, r.leaf, r.subroot, tuple((s.left.hex(), s.right.hex()) for s in r.path))
                   for r in made.proofs.collect()), key=str)


def wanted(rows, fanout=8):
    return sorted(((r[0], r[2], d, sub, tuple(("".join(a), "".join(b)) for a, b in path))
                   for r, d, sub, _, path in brute(rows, fanout)), key=str)


@pytest.mark.parametrize("fanout", [2, 8])
def test_equals_brute_force(spark, fanout):
    langs = ["en", "fr", None, "zé", "Z", "a", "b", "c", "d", "e", "f"]
    rows = [(i, f"text {i}", langs[min(i % 40, 10)] if i % 3 else "en", "s") for i in range(300)]
    made = merkle.manifest(docs(spark, rows), Scratch(spark), fanout=fanout, keep={"doc_id": F.col("doc_id")})
    assert made.root == brute(full(rows), fanout)[0][3]
    assert proofs(made) == wanted(full(rows), fanout)
    subs = {r.tree: (r.n_leaves, r.subroot) for r in made.subroots.collect()}
    assert subs == {r[2]: (sum(x[2] == r[2] for x in full(rows)), sub) for r, _, sub, _, _ in brute(full(rows), fanout)}


def test_odd_rows_and_repeats(spark):
    rows = [*odd_rows(), *[(9, "same", "en")] * 30, *[(None, "same", None)] * 9, (10, "x", "lone")]
    made = merkle.manifest(docs(spark, rows), Scratch(spark), keep={"doc_id": F.col("doc_id")})
    assert made.root == brute(full(rows))[0][3]
    assert proofs(made) == wanted(full(rows))


def test_salted_joins_give_the_same(spark, monkeypatch):
    """Ancestors stand in the join once per SALT_ROWS leaves: no key meets a third of all rows."""
    rows = [(i, f"t{i}", "en" if i % 5 else "fr") for i in range(900)]
    monkeypatch.setattr(merkle, "SALT_ROWS", 7)
    made = merkle.manifest(docs(spark, rows), Scratch(spark), keep={"doc_id": F.col("doc_id")})
    assert proofs(made) == wanted(full(rows))


def test_one_tree_one_row_no_rows(spark):
    one = merkle.manifest(docs(spark, [(1, "x")]), Scratch(spark), keep={"doc_id": F.col("doc_id")})
    row = one.proofs.collect()[0]
    assert one.root == row.leaf == row.subroot == leaf(1, "x", "en", "s", 1) and row.path == []
    none = merkle.manifest(empty(spark), Scratch(spark), keep={"doc_id": F.col("doc_id")})
    assert none.root is None and none.proofs.count() == 0 and none.subroots.count() == 0


def test_tampering_shows_and_clashing_columns(spark):
    rows = [(i, f"Text {i}") for i in range(70)]
    df = docs(spark, rows).selectExpr("*", "1 as i", "'x' as T", "2 as digest", "3 as leaves", "4 as path", "5 as salt", "6 as tree")
    made = merkle.manifest(df, Scratch(spark), keep={"doc_id": F.col("doc_id")})
    assert proofs(made) == wanted(full(rows))
    back = made.proofs.select("doc_id", merkle.fold(F.col("leaf"), F.col("path")).alias("f"),
                              merkle.fold(F.sha2(F.lit("y").cast("binary"), 256), F.col("path")).alias("g")).collect()
    assert all(r.f == made.root and r.g != made.root for r in back)


def test_other_fields_and_string_ids(spark):
    df = spark.createDataFrame([(f"d{i}", f"g{i % 2}", i) for i in range(20)], "id string, grp string, v int")
    made = merkle.manifest(df, Scratch(spark), fields=("id", "v"), tree="grp", order="id", keep={"id": F.col("id")})
    got = {r.id: (r.place, r.leaf) for r in made.proofs.collect()}
    assert got["d0"] == (0, h("2:d0", "1:0")) and got["d12"][0] == 2 and len(got) == 20  # d0 d10 d12 d14 ...


def test_query_digest(spark):
    sf = "/root/testdata/sf0.001"
    raw = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = {r.doc_id: r for r in queries.op12_merkle(spark, sf).collect()}
    assert len(got) == len(raw)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for row, d, sub, root, path in brute(raw):
        r = got[row[0]]
        hit = zlib.crc32(str(row[0]).encode()) % 3 == 0
        text = row[1].translate(lower) if hit and row[1] is not None else row[1]
        end = folded(leaf(row[0], text, *row[2:]), path)
        assert (r.leaf, r.subroot, r.root, r.folded_root, r.verified) == (d, sub, root, end, end == root)
        assert r.proof_sha256 == h(*["".join(a) + "".join(b) for a, b in path])
