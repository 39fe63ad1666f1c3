"""SimHash near-duplicates over BK-trees.

A text's fingerprint is the bitwise majority of the XXH64 hashes of its word
shingles.  Fingerprints within ``max_bits`` differing bits are linked and links
are closed into groups.

Finding the links exactly without comparing everything with everything:

* equal fingerprints collapse to one row first (exact copies and most very near
  copies cost nothing further);
* the 64 bits are cut into ``max_bits + 2`` blocks.  Two fingerprints that differ
  in at most ``max_bits`` bits agree on at least two whole blocks, so every link
  lies in a bucket keyed by (a pair of blocks, their bits);
* the members of a bucket are a *shard*: a BK-tree (children keyed by their
  integer distance to the parent) is built from them, and every query follows
  only the edges within the radius.  The shard trees travel to the queries by a
  shuffle on the bucket key, not by a broadcast of all trees to everyone: a
  broadcast of every tree grows with the corpus, a bucket does not;
* a bucket larger than ``shard_rows`` is cut into chunks, and each (tree chunk,
  query chunk) pair is a task of its own, so no tree exceeds ``shard_rows``
  whatever the skew.  All pairs of chunks are visited: nothing is dropped.

A task never emits the pairs it finds, only a spanning forest of them (at most
one edge per member); the forests meet in the distributed union-find.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gocledger.llm.common import Scratch, arrow_map, pieces, utf8
from gocledger.llm.components import connected_components

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
SHARD_ROWS = 4096

#: (tree, query) pairs compared at once in a task.
_FRONTIER = 1 << 20
#: Shingle hashes counted at once (64 bytes each).
_HASHES = 1 << 16
_BREAK = re.compile(rb"[\x20\x09-\x0d]")


# ------------------------------------------------------------------ fingerprints
def fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one whole text, as a signed 64-bit integer (no words: 0)."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for hashes in _shingle_hashes(text, k):
        h = np.array(hashes, dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    bits = np.packbits(ones * 2 > n, bitorder="little") if n else np.zeros(8, np.uint8)
    return int(bits.view("<i8")[0])


def _shingle_hashes(text: str | None, k: int) -> Iterator[list[int]]:
    """XXH64 of every k-word shingle of the text, in lists of bounded size."""
    hash_of = xxhash.xxh64_intdigest
    tail: list[bytes] = []
    any_full = False
    for piece in pieces(utf8(text), _BREAK):
        words = tail + piece.split()
        n = len(words) - k + 1
        if n > 0:
            any_full = True
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            for i in range(0, n, _HASHES):
                j = min(n, i + _HASHES)
                yield [hash_of(joined[a:b], SEED)
                       for a, b in zip(starts[i:j].tolist(), ends[i + k - 1:j + k - 1].tolist())]
        tail = words[max(0, len(words) - k + 1):]
    if not any_full and tail:
        yield [hash_of(b" ".join(tail), SEED)]


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS, text: str = "text") -> DataFrame:
    """``docs`` plus ``fingerprint_bits`` (long).  Null, empty and word-free texts get 0."""
    def rows(batch: pa.RecordBatch) -> dict:
        texts = batch.column(batch.schema.get_field_index(text))
        return {"fingerprint_bits": [fingerprint(t.as_py(), k) for t in texts]}

    return arrow_map(docs, rows, T.StructType([T.StructField("fingerprint_bits", T.LongType())]))


# ------------------------------------------------------------------ BK-trees
def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges [lo, hi): (index of the range, every integer in it)."""
    n = hi - lo
    owner = np.repeat(np.arange(len(lo)), n)
    first = np.cumsum(n) - n
    return owner, np.arange(int(n.sum())) - np.repeat(first, n) + np.repeat(lo, n)


class BKForest:
    """One BK-tree per group over distinct 64-bit fingerprints, built level by level.

    Nodes are indices into ``fp``.  An edge is stored as (parent * 65 + distance,
    child), sorted, so the children of a node within a distance window are one
    contiguous range.
    """

    def __init__(self, fp: np.ndarray, group: np.ndarray, nodes: np.ndarray) -> None:
        self.fp = fp
        keys: list[np.ndarray] = []
        kids: list[np.ndarray] = []
        groups, first = np.unique(group[nodes], return_index=True)
        self.roots = dict(zip(groups.tolist(), nodes[first].tolist()))
        lead = np.full(int(group.max()) + 1 if len(group) else 0, -1, dtype=np.int64)
        lead[groups] = nodes[first]
        self.lead = lead
        item = nodes[~np.isin(nodes, nodes[first], assume_unique=True)]
        at = lead[group[item]]
        while len(item):
            d = np.bitwise_count(fp[item] ^ fp[at]).astype(np.int64)
            key = at * 65 + d
            uniq, head, where = np.unique(key, return_index=True, return_inverse=True)
            child = item[head]
            keys.append(uniq)
            kids.append(child)
            at = child[where]
            rest = at != item
            item, at = item[rest], at[rest]
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        kid = np.concatenate(kids) if kids else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.kid = key[order], kid[order]

    def within(self, queries: np.ndarray, at: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (query, node) at most ``radius`` bits apart; ``at``: the root of each query's tree."""
        todo = [(queries, at)]
        while todo:
            q, node = todo.pop()
            if len(q) > _FRONTIER:
                half = len(q) // 2
                todo += [(q[:half], node[:half]), (q[half:], node[half:])]
                continue
            d = np.bitwise_count(self.fp[q] ^ self.fp[node]).astype(np.int64)
            hit = d <= radius
            if hit.any():
                yield q[hit], node[hit]
            lo = np.searchsorted(self.key, node * 65 + np.maximum(d - radius, 0), "left")
            hi = np.searchsorted(self.key, node * 65 + np.minimum(d + radius, 64), "right")
            go = hi > lo
            if go.any():
                owner, edge = _expand(lo[go], hi[go])
                todo.append((q[go][owner], self.kid[edge]))


class _Union:
    """Union-find over 0..n-1 for blocks of links: labels only ever decrease."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            hi, lo = np.maximum(x, y)[apart], np.minimum(x, y)[apart]
            np.minimum.at(self.label, hi, lo)
            while True:
                nxt = self.label[self.label]
                if (nxt == self.label).all():
                    break
                self.label = nxt


def _forest_edges(fp: np.ndarray, bucket: np.ndarray, chunk: np.ndarray, partner: np.ndarray,
                  radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forests of whole (bucket, tree chunk, query chunk) tasks; rows are sorted by task."""
    new = np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (partner[1:] != partner[:-1])))
    group = np.cumsum(new) - 1
    i, j = partner // (1 << 20), partner % (1 << 20)
    forest = BKForest(fp, group, np.flatnonzero(chunk == i))
    queries = np.flatnonzero(chunk == j)
    links = _Union(len(fp))
    root = forest.lead[group[queries]]
    queries, root = queries[root >= 0], root[root >= 0]
    for q, node in forest.within(queries, root, radius):
        links.add(q, node)
    member = np.flatnonzero(links.label != np.arange(len(fp)))
    return fp[member], fp[links.label[member]]


def _search(radius: int, batch_rows: int):
    """mapInArrow function over rows sorted by (bucket, partner): whole tasks are
    gathered across batches, about ``batch_rows`` rows at a time."""
    names = ("bits", "bucket", "chunk", "partner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        rows = 0

        def solve(cols: dict[str, np.ndarray]) -> pa.RecordBatch:
            a, b = _forest_edges(cols["bits"].view(np.uint64), cols["bucket"], cols["chunk"], cols["partner"], radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        def joined() -> dict[str, np.ndarray]:
            return {n: np.concatenate([h[n] for h in held]) for n in names}

        for batch in batches:
            cols = {n: batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names}
            if not len(cols["bits"]):
                continue
            held.append(cols)
            rows += len(cols["bits"])
            if rows < batch_rows:
                continue
            cols = joined()
            last = (cols["bucket"] == cols["bucket"][-1]) & (cols["partner"] == cols["partner"][-1])
            cut = int(np.argmax(last))
            if cut:
                yield solve({n: v[:cut] for n, v in cols.items()})
            held, rows = [{n: v[cut:] for n, v in cols.items()}], len(last) - cut
        if rows:
            yield solve(joined())

    return run


def block_pairs(max_bits: int) -> list[list[tuple[int, int]]]:
    """Pairs of (offset, width) blocks of 64 bits such that ``max_bits`` flips leave a pair untouched."""
    n = max_bits + 2
    if not 0 <= max_bits <= 30:
        raise ValueError("max_bits must be between 0 and 30")
    widths = [64 // n + (i < 64 % n) for i in range(n)]
    blocks, at = [], 0
    for w in widths:
        blocks.append((at, w))
        at += w
    return [list(p) for p in combinations(blocks, 2)]


def links_forest(bits: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (a, b) whose components are those of the graph of all links among distinct ``bits``."""
    def part(off: int, width: int) -> F.Column:
        return F.shiftrightunsigned("bits", off).bitwiseAND(F.lit((1 << width) - 1))

    keys = [(F.lit(n) * F.lit(1 << 56)) + F.shiftleft(part(*p), q[1]) + part(*q) if p[1] + q[1] < 56
            else F.xxhash64(F.lit(n), part(*p), part(*q)) for n, (p, q) in enumerate(block_pairs(max_bits))]
    keyed = bits.select("bits", F.explode(F.array(*keys)).alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    chunks = F.ceil(F.col("n") / F.lit(float(shard_rows))).cast("long")
    tasks = (keyed.join(sizes, "bucket")
             .select("bits", "bucket", chunks.alias("chunks"),
                     F.pmod(F.xxhash64(F.col("bits"), F.lit(SEED)), chunks).alias("chunk"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
             .select("bits", "bucket", "chunk",
                     (F.least("chunk", "other") * F.lit(1 << 20) + F.greatest("chunk", "other")).alias("partner")))
    dealt = tasks.repartition("bucket", "partner").sortWithinPartitions("bucket", "partner", "bits")
    return dealt.mapInArrow(_search(max_bits, 1 << 16), "a long, b long")


# ------------------------------------------------------------------ operator
def simhash_groups(docs: DataFrame, scratch: Scratch, *, k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                   shard_rows: int = SHARD_ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, fingerprint_bits, component_id, keep_id, keep_key) for every row of ``docs``.

    ``text_key`` is xxhash64 of the text; ``component_id`` the smallest doc_id
    reachable over links; (keep_id, keep_key) name the group's representative:
    the smallest doc_id (nulls last), then the smallest text_key.

    Null and empty texts have fingerprint zero and link like any other row.
    Repeated rows land in the same group.  A null doc_id never becomes a
    component_id unless the whole group has none.  No rows: no rows.
    """
    base = fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                                    F.xxhash64(F.col(text)).alias("text_key")), k).drop("text")
    prints = scratch.cut(base, "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    distinct = prints.groupBy(F.col("fingerprint_bits").alias("bits")).agg(first)
    distinct = scratch.cut(distinct, "distinct-fingerprints")
    labels = connected_components(links_forest(distinct.select("bits"), max_bits, shard_rows), scratch, "simhash-links")
    rooted = distinct.join(labels, distinct.bits == labels.node, "left").select(
        "bits", "first", F.coalesce("component", "bits").alias("root"))
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    of = rooted.join(best, "root").select("bits", F.col("best.doc_id").alias("component_id"),
                                          F.col("best.doc_id").alias("keep_id"), F.col("best.text_key").alias("keep_key"))
    return (prints.join(of, prints.fingerprint_bits == of.bits)
            .select("doc_id", "text_key", "fingerprint_bits", "component_id", "keep_id", "keep_key"))


def hex_fingerprint(bits: F.Column) -> F.Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


def keep_one_per_group(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """``docs`` with one row of each SimHash group: the representative of :func:`simhash_groups`.

    Rows that repeat the representative in doc_id and text collapse to one of them.
    """
    groups = simhash_groups(docs, scratch, **options)

    def keys(doc_id: str, text_key: F.Column) -> dict:
        # Never null, so that the join and the collapse share one shuffle of the texts.
        return {"__none": F.col(doc_id).isNull(), "__id": F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "__key": text_key}

    names = ["__none", "__id", "__key"]
    kept = groups.withColumns(keys("keep_id", F.coalesce("keep_key", F.lit(0)))).select(*names).distinct()
    marked = docs.withColumns(keys(options.get("doc_id", "doc_id"), F.coalesce(F.xxhash64(F.col(options.get("text", "text"))), F.lit(0))))
    return marked.join(kept, names, "left_semi").dropDuplicates(names).drop(*names)
