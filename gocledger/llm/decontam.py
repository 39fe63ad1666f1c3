"""Benchmark decontamination with training suffix arrays.

Documents are the training side.  A task gathers documents, across Arrow batches,
into shards of bounded words; the words of a shard are sorted into a suffix array
(prefix doubling: ranks of all 1, 2, 4, ... word prefixes, so the order is that of
whole suffixes).  Every test suffix is binary-searched in the shard's array: the
range that shares its window's words holds all places where the window occurs,
and the longest verbatim match of a place is its longest common prefix with the
test suffixes beside it in that order, read off the ranks in as many steps as the
length has binary digits.  Equal test windows are one group, and the ranges of
different groups are disjoint, so a shard's places are at most its words, however
often a word repeats.

Only what can match is sorted: a match of two or more words is a chain of word
pairs that both sides have, so both sides are first reduced to such chains of at
least a window's length.  A clean shard leaves next to nothing.

The benchmark is the broadcast side, in blocks of at most ``block_bytes`` of text
(by a hash of the item).  One block: documents never shuffle and nothing is
written.  More blocks: the documents are written once under row numbers, each
block's pass returns its hits only, and the hits are merged by row number; no
broadcast exceeds the bound and a benchmark of any size gives whole results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gocledger.llm.common import Scratch, alnum_words, shield, without

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_WORDS = 1 << 18

ADDED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_starts", T.ArrayType(T.LongType())),
    T.StructField("hit_ends", T.ArrayType(T.LongType())),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("longest_match", T.LongType()),
])


class TestIndex:
    """One block of benchmark items as word numbers, made once and broadcast.

    ``words`` maps a word to 1, 2, ...; ``ids`` lays the items end to end, each
    followed by 0.  ``need``: words of the window that begins at a position (0: none),
    ``item``: its item's number.  ``pairs``: all pairs of neighbouring words, sorted, and
    ``pair_at``/``pair_from`` where each begins.
    """

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        self.words: dict[bytes, int] = {}
        self.names: list[str | None] = []
        ids: list[np.ndarray] = [np.zeros(1, np.int32)]
        need: list[np.ndarray] = [np.zeros(1, np.int32)]
        item: list[np.ndarray] = [np.full(1, -1, np.int32)]
        for name, text in items:
            own = np.array([self.words.setdefault(w, len(self.words) + 1) for part in alnum_words(text) for w in part], np.int32)
            if not len(own):
                continue
            size = min(window, len(own))
            begins = np.zeros(len(own) + 1, np.int32)
            begins[:len(own) - size + 1] = size
            ids.append(np.append(own, np.int32(0)))
            need.append(begins)
            item.append(np.full(len(own) + 1, len(self.names), np.int32))
            self.names.append(name)
        self.ids, self.need, self.item = np.concatenate(ids), np.concatenate(need), np.concatenate(item)
        self.shortest = int(self.need[self.need > 0].min()) if self.names else 0
        code = self.pair_codes(self.ids)
        at = np.flatnonzero(code)
        order = at[np.argsort(code[at], kind="stable")]
        self.pairs, start = np.unique(code[order], return_index=True)
        self.pair_at, self.pair_from = order.astype(np.int32), np.append(start, len(order))

    def pair_codes(self, ids: np.ndarray) -> np.ndarray:
        """A number for each position's word and the next; 0 where either is unknown."""
        code = np.zeros(len(ids), np.int64)
        both = (ids[:-1] > 0) & (ids[1:] > 0)
        code[:-1][both] = ids[:-1][both].astype(np.int64) * (len(self.words) + 1) + ids[1:][both]
        return code

    def has_pair(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.zeros(len(codes), bool)
        at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
        return self.pairs[at] == codes

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Where the given pairs (sorted, all known) begin in ``ids``."""
        k = np.searchsorted(self.pairs, codes)
        sizes = self.pair_from[k + 1] - self.pair_from[k]
        return self.pair_at[np.repeat(self.pair_from[k] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))]


def _chains(ids: np.ndarray, known: np.ndarray, link: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The chains of at least ``least`` words, end to end, each followed by 0; and each entry's
    position in ``ids`` (-1 behind a chain).  ``link``: a position goes on with the next."""
    begin = known.copy()
    begin[1:] &= ~link[:-1]
    chain = np.cumsum(begin) - 1
    sizes = np.bincount(chain[known], minlength=1) if known.any() else np.zeros(1, np.int64)
    at = np.flatnonzero(known)
    at = at[sizes[chain[at]] >= least]
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    nth = np.cumsum(np.concatenate([[0], (chain[at][1:] != chain[at][:-1]).astype(np.int64)]))
    words, where = np.zeros(len(at) + int(nth[-1]) + 1, np.int64), np.full(len(at) + int(nth[-1]) + 1, -1, np.int64)
    words[np.arange(len(at)) + nth], where[np.arange(len(at)) + nth] = ids[at], at
    return words, where


class _Suffixes:
    """Ranks of all 2^j-word prefixes of the suffixes of ``words`` (0 ends a chain)."""

    def __init__(self, words: np.ndarray, most: int) -> None:
        ends = np.flatnonzero(words == 0)
        self.run = ends[np.searchsorted(ends, np.arange(len(words)))] - np.arange(len(words))
        live = np.flatnonzero(self.run)
        first = np.zeros(len(words), np.int32)
        first[live] = np.unique(words[live], return_inverse=True)[1] + 1
        self.ranks = [first]
        while (1 << (len(self.ranks) - 1)) < most:
            half, low = 1 << (len(self.ranks) - 1), self.ranks[-1]
            after = np.zeros(len(live), np.int64)
            more = self.run[live] > half
            after[more] = low[live[more] + half]
            rank = np.zeros(len(words), np.int32)
            rank[live] = np.unique(low[live].astype(np.int64) * (len(words) + 1) + after, return_inverse=True)[1] + 1
            self.ranks.append(rank)

    def prefix(self, at: np.ndarray, k: int) -> np.ndarray:
        """A number for the first ``k`` words of each suffix (all at least that long), in their order."""
        j = k.bit_length() - 1
        low = self.ranks[j]
        return low[at].astype(np.int64) * (len(low) + 1) + low[at + k - (1 << j)]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``a`` and ``b`` begin with in common."""
        n = np.zeros(len(a), np.int64)
        for j in range(len(self.ranks) - 1, -1, -1):
            fits = np.minimum(self.run[a], self.run[b]) >= n + (1 << j)
            same = fits.copy()
            same[fits] = self.ranks[j][(a + n)[fits]] == self.ranks[j][(b + n)[fits]]
            n[same] += 1 << j
        return n


def find_matches(ids: np.ndarray, test: TestIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Over one shard of word numbers (0: words the benchmark lacks, and between documents):
    places, window lengths and longest matches of all hits, each place at most once per window
    length; and as many (place, item) pairs as needed to name each hit's items, as two more arrays."""
    none = np.zeros(0, np.int64)
    if not test.shortest or not len(ids):
        return none, none, none, none, none
    known = ids > 0
    code = test.pair_codes(ids)
    link = test.has_pair(code) & (code > 0)
    train, train_at = _chains(ids, known, link, test.shortest)
    if not len(train):
        return none, none, none, none, none
    there = test.pair_codes(train)
    link = np.zeros(len(test.ids), bool)
    link[test.positions(np.unique(there[there > 0]))] = True
    near = link.copy()
    near[1:] |= link[:-1]
    if test.shortest == 1:
        have = np.zeros(len(test.words) + 1, bool)
        have[train] = True
        near |= have[test.ids] & (test.ids > 0)
    query, query_at = _chains(test.ids, near, link, test.shortest)
    if not len(query):
        return none, none, none, none, none
    n = len(train)
    both = np.concatenate([train, query])
    lengths = _longest_chains(train), _longest_chains(query)
    order = _Suffixes(both, max(1, min(lengths)))
    rank = order.ranks[-1]
    array = np.flatnonzero(train)
    array = array[np.argsort(rank[array], kind="stable")]                 # the shard's suffix array
    tests = n + np.flatnonzero(query)
    need = test.need[query_at[tests - n]]
    places, sizes, pair_place, pair_item = [none], [none], [none], [none]
    for k in np.unique(need[need > 0]).tolist():
        fit = array[order.run[array] >= k]
        windows = tests[(need == k) & (order.run[tests] >= k)]
        if not len(fit) or not len(windows):
            continue
        groups, group = np.unique(order.prefix(windows, k), return_inverse=True)
        keys = order.prefix(fit, k)
        lo, hi = np.searchsorted(keys, groups, "left"), np.searchsorted(keys, groups, "right")
        count = hi - lo
        place = fit[np.repeat(lo - np.cumsum(count) + count, count) + np.arange(int(count.sum()))]
        of = np.repeat(np.arange(len(groups)), count)
        places.append(place)
        sizes.append(np.full(len(place), k, np.int64))
        # Items of a group, each once; a group's places in one document need them once.
        items = np.unique(np.stack([group, test.item[query_at[windows - n]]], axis=1), axis=0)
        first = np.searchsorted(items[:, 0], np.arange(len(groups) + 1))
        doc = np.cumsum(ids == 0)[train_at[place]]
        _, one = np.unique(doc.astype(np.int64) * len(groups) + of, return_index=True)
        many = (first[1:] - first[:-1])[of[one]]
        pair_place.append(np.repeat(train_at[place[one]], many))
        pair_item.append(items[np.repeat(first[of[one]] - np.cumsum(many) + many, many) + np.arange(int(many.sum())), 1])
    place = np.concatenate(places)
    beside = tests[np.argsort(rank[tests], kind="stable")]
    at = np.searchsorted(rank[beside], rank[place])
    longest = np.maximum(order.common(place, beside[np.minimum(at, len(beside) - 1)]), order.common(place, beside[np.maximum(at - 1, 0)]))
    return train_at[place], np.concatenate(sizes), longest, np.concatenate(pair_place), np.concatenate(pair_item)


def _longest_chains(words: np.ndarray) -> int:
    ends = np.flatnonzero(words == 0)
    return int(np.diff(np.concatenate([[-1], ends])).max()) - 1


def _doc_ids(text: str | None, words: dict[bytes, int]) -> np.ndarray:
    parts = [np.fromiter(map(words.get, part, repeat(0)), np.int32, len(part)) for part in alnum_words(text)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def _shard(docs: list[np.ndarray], test: TestIndex) -> list[tuple[int, np.ndarray, np.ndarray, set[int], int]]:
    """Per document of one shard: words, starts and ends of its hit spans, item numbers, longest match."""
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    first = np.cumsum(lengths + 1) - lengths - 1
    ids = np.zeros(int((lengths + 1).sum()), dtype=np.int32)
    for at, d in zip(first.tolist(), docs):
        ids[at:at + len(d)] = d
    place, size, length, of, item = find_matches(ids, test)
    marks = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(marks, place, 1)
    np.add.at(marks, place + size, -1)
    longest = np.zeros(len(docs), dtype=np.int64)
    np.maximum.at(longest, np.searchsorted(first, place, "right") - 1, length)
    items: list[set[int]] = [set() for _ in docs]
    for d, i in zip((np.searchsorted(first, of, "right") - 1).tolist(), item.tolist()):
        items[d].add(i)
    hit = (np.cumsum(marks[:-1]) > 0).astype(np.int8)
    edge = np.diff(np.concatenate(([0], hit, [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(first, starts, "right") - 1
    cuts = np.searchsorted(owner, np.arange(len(docs) + 1))
    return [(int(lengths[d]), starts[a:b] - first[d], ends[a:b] - first[d], items[d], int(longest[d]))
            for d, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist()))]


def _pass(df: DataFrame, items: list[tuple[str | None, str | None]], window: int, shard_words: int, text: str,
          keep: list[str], hits_only: bool) -> DataFrame:
    """One block of items over all documents; ``hits_only``: only rows with a hit."""
    test = df.sparkSession.sparkContext.broadcast(TestIndex(items, window))
    schema = T.StructType([df.schema[c] for c in keep] + list(ADDED))
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = test.value
        waiting: list[pa.RecordBatch] = []
        docs: list[np.ndarray] = []
        words = 0

        def solved() -> Iterator[pa.RecordBatch]:
            rows = iter(_shard(docs, index))
            for part in waiting:
                own = [next(rows) for _ in range(len(part))]
                if hits_only:
                    use = [i for i, r in enumerate(own) if len(r[1])]
                    part, own = part.take(pa.array(use, pa.int64())), [own[i] for i in use]
                out = [[r[0] for r in own], [r[1].tolist() for r in own], [r[2].tolist() for r in own],
                       [sorted({index.names[i] for i in r[3]} - {None}) for r in own], [r[4] for r in own]]
                arrays = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(v, k) for v, k in zip(out, kinds))], names=[*keep, *ADDED.names])
            waiting.clear()
            docs.clear()

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            start = 0
            for i in range(len(batch)):
                docs.append(_doc_ids(texts[i].as_py(), index.words))
                words += len(docs[-1]) + 1
                if words >= shard_words:
                    waiting.append(batch.slice(start, i + 1 - start))
                    yield from solved()
                    start, words = i + 1, 0
            if start < len(batch):
                waiting.append(batch.slice(start))
        if docs:
            yield from solved()

    return df.mapInArrow(run, schema)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: the hits that several blocks found in a row as one."""
    for batch in batches:
        rows = batch.to_pydict()
        starts, ends = [], []
        for some in rows["spans"]:
            s: list[int] = []
            e: list[int] = []
            for x in sorted((x["s"], x["e"]) for x in some):
                if e and x[0] <= e[-1]:
                    e[-1] = max(e[-1], x[1])
                else:
                    s.append(x[0])
                    e.append(x[1])
            starts.append(s)
            ends.append(e)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())),
             pa.array([sorted(set(x)) for x in rows["items"]], pa.list_(pa.string())), pa.array(rows["longest_match"], pa.int64())],
            names=["__row", *ADDED.names[1:]])


def annotate(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, *, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
             shard_words: int = SHARD_WORDS, text: str = "text", item_id: str = "item_id", item_text: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``, default all) plus n_words, hit_starts, hit_ends (word spans,
    sorted and disjoint), item_ids (strings, sorted) and longest_match (words).

    Null and empty texts have no words and no hits; an item without words has no
    window; a null item_id hits words but is not listed; repeated items count
    once.  An empty benchmark hits nothing.  Input columns named like an added
    one are replaced.  A single item larger than a block makes its block larger, a
    document larger than a shard its shard.
    """
    base = without(docs, ADDED.names)
    keep = [c for c in base.columns if keep is None or c in keep]
    items = benchmark.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("words")).distinct()
    total = items.agg(F.sum(F.octet_length("words")).alias("b")).first()["b"] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("name", "words"), F.lit(blocks))

    def of_block(b: int) -> list[tuple[str | None, str | None]]:
        return [(r["name"], r["words"]) for r in items.where(block == b).toLocalIterator()]

    if blocks == 1:
        return _pass(base, of_block(0), window, shard_words, text, keep, hits_only=False)
    rows = scratch.cut(base.select(*[*dict.fromkeys([*keep, text])], F.monotonically_increasing_id().alias("__row")), "decontam-rows")
    found: DataFrame | None = None
    for b in range(blocks):
        part = scratch.cut(_pass(rows.select("__row", text), of_block(b), window, shard_words, text, ["__row"], hits_only=b > 0),
                           "decontam-hits")
        found = part if found is None else found.unionByName(part)
    each = found.withColumn("spans", F.zip_with("hit_starts", "hit_ends", lambda s, e: F.struct(s.alias("s"), e.alias("e"))))
    gathered = each.groupBy("__row").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("item_ids")).alias("items"),
        F.max("longest_match").alias("longest_match"))
    merged = gathered.select("__row", "spans", "items", "longest_match").mapInArrow(
        _merged, "__row long, hit_starts array<long>, hit_ends array<long>, item_ids array<string>, longest_match long")
    words = found.groupBy("__row").agg(F.max("n_words").alias("n_words"))
    return rows.join(words, "__row").join(merged, "__row").select(*keep, *ADDED.names)


def hit_words(starts: Column, ends: Column) -> Column:
    """Words inside disjoint spans."""
    return F.aggregate(F.zip_with(starts, ends, lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """``docs`` without the documents that hold any benchmark window."""
    safe, back = shield(docs, ADDED.names)
    marked = annotate(safe, benchmark, scratch, **options)
    return marked.where(F.size("hit_starts") == 0).select(*safe.columns).withColumnsRenamed(back)
