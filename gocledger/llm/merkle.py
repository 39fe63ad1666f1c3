"""Merkle dataset manifest: hash trees over a table, a proof for every row by pointer jumping.

Every row is a leaf (sha256 over its length-prefixed fields).  The leaves of one
tree (``tree``, say a language) ascend by ``order``; every ``fanout`` consecutive
nodes become their parent until one is left, the subroot; the subroots, ordered
by tree, give the root in the same way.  Places in a tree come from one range
sort and per-partition offsets, so no tree has to fit into one task.

Proofs: each node first holds the siblings of one step (what stands left and
right of it in its run) and points at its parent.  A round of pointer jumping
joins every node with the node it points at, appends that node's siblings to its
own and takes over that node's pointer, so the distance doubles: a forest of
depth d takes log2(d) rounds, not d.  Only inner nodes (a seventh of the leaves
at fanout 8) are written between rounds; the leaves pass through all joins in one
job.

An ancestor shared by many leaves is a hot join key: a node stands in the join
once per ``SALT_ROWS`` leaves below it, and whoever points at it picks a copy by
its own number, so that no key meets more than about ``SALT_ROWS`` leaves, the
root included.  Digests travel as 32 bytes; hex text is made only to be hashed or
returned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gocledger.llm.common import Scratch, null_safe

FANOUT = 8
#: Leaves below one copy of a node in a pointer join.
SALT_ROWS = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree number of the tree over the subroots.
_TOP = -1


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value (integers decimal)."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    """Hex digest of one row's fields."""
    return F.sha2(F.concat(*map(encoded, values)).cast("binary"), 256)


def _text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def fold(leaf: Column, path: Column) -> Column:
    """Hex digest that ``leaf`` (hex) and a path of (left, right) siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(
        F.concat(_text(s["left"]), node, _text(s["right"])).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """Hex digest over all siblings of a path, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(
        path, lambda s: F.concat(_text(s["left"]), _text(s["right"])))).cast("binary"), 256)


def levels(n: Column, fanout: int) -> Column:
    """How many levels of runs lie above a tree's ``n`` leaves."""
    count, width = F.lit(0), 1
    while width < 1 << 62:
        count = count + (n > width).cast("int")
        width *= fanout
    return count


def _height(n: int, fanout: int) -> int:
    height = 0
    while n > 1:
        n, height = -(-n // fanout), height + 1
    return height


@dataclass
class Manifest:
    """``root`` (hex; None without rows), ``subroots`` (tree, n_leaves, subroot) and ``proofs``:
    one row per leaf with the kept columns, tree, place in the tree, ``leaf``, ``subroot``
    (hex) and ``path``, an array of (left, right) sibling digests from the leaf to the root."""

    root: str | None
    subroots: DataFrame
    proofs: DataFrame


def _placed(leaves: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Leaves with their tree's number ``t``, their place ``i`` in it and its size ``n``;
    and the trees (tree, t, n)."""
    cut = scratch.cut(leaves.withColumn("mid", F.monotonically_increasing_id()), "merkle-leaves")
    keys = ["tree", "key", "digest", "mid"]  # mid parts equal rows, so that any number of them spreads over the ranges
    ordered = scratch.cut(
        cut.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "merkle-ordered")
    runs = ordered.groupBy("part", "tree").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("rows"))
    of_tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = scratch.cut(runs.select("part", "tree", (before - F.col("start")).alias("shift"),
                                    F.sum("rows").over(of_tree).alias("n")), "merkle-offsets")
    # The trees take numbers in their own order, again without one task for all of them.
    trees = shift.groupBy("tree").agg(F.max("n").alias("n"))
    trees = scratch.cut(trees.repartitionByRange("tree").sortWithinPartitions("tree")
                        .select("tree", "n", F.spark_partition_id().alias("part"),
                                F.monotonically_increasing_id().alias("at")), "merkle-trees")
    firsts = trees.groupBy("part").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("rows"))
    # One row per partition of the line above, never more than spark.sql.shuffle.partitions.
    first = firsts.select("part", (F.coalesce(F.sum("rows").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("start")).alias("first"))
    numbered = trees.join(first, "part").select("tree", "n", (F.col("at") + F.col("first")).alias("t"))
    shift = null_safe(shift, numbered.select("tree", "t"), ["tree"], "inner")
    placed = null_safe(ordered, shift, ["part", "tree"], "inner")
    return placed.withColumn("i", F.col("at") + F.col("shift")).drop("mid", "part", "at", "shift", "key"), numbered


def _runs(nodes: DataFrame, fanout: int, carry: Sequence[str]) -> DataFrame:
    """The next level: a row per run with its nodes in order (``kids``)."""
    kid = F.struct("i", "digest", "leaves", *carry)
    return (nodes.where(F.col("n") > 1)
            .groupBy("t", F.floor(F.col("i") / fanout).cast("long").alias("run"), "n")
            .agg(F.array_sort(F.collect_list(kid)).alias("kids")))


def _parents(runs: DataFrame, fanout: int) -> DataFrame:
    hashed = F.sha2(F.concat_ws("", F.transform("kids", lambda k: _text(k["digest"]))).cast("binary"), 256)
    return runs.select(
        "t", F.col("run").alias("i"), F.ceil(F.col("n") / fanout).cast("long").alias("n"), F.unhex(hashed).alias("digest"),
        F.aggregate("kids", F.lit(0).cast("long"), lambda s, k: s + k["leaves"]).alias("leaves"))


def _pointers(runs: DataFrame, level: int, fanout: int, carry: Sequence[str]) -> DataFrame:
    """Every node of the runs with its own siblings and a pointer (at, al, ai) at its parent;
    the parent that is a tree's last node is that tree's leaf in the tree of subroots."""
    ends = (F.ceil(F.col("n") / fanout) == 1) & (F.col("t") != _TOP)
    one = runs.select(
        "t", "n", "run", "kids", F.aggregate("kids", F.lit(0).cast("long"), lambda s, k: s + k["leaves"]).alias("aleaves"),
        F.posexplode("kids").alias("p", "kid"))
    joined = "aggregate({}, X'', (a, k) -> concat(a, k.digest))"
    step = F.struct(F.expr(joined.format("slice(kids, 1, p)")).alias("left"),
                    F.expr(joined.format("slice(kids, p + 2, size(kids))")).alias("right"))
    return one.select(
        "t", F.lit(level).alias("l"), F.col("kid.i").alias("i"), F.col("kid.leaves").alias("leaves"), "n",
        F.when(ends, F.lit(_TOP)).otherwise(F.col("t")).cast("long").alias("at"),
        F.when(ends, F.lit(0)).otherwise(F.lit(level + 1)).alias("al"),
        F.when(ends, F.col("t")).otherwise(F.col("run")).alias("ai"), "aleaves",
        F.col("kid.digest").alias("digest"), F.array(step).alias("path"), *[F.col(f"kid.{c}").alias(c) for c in carry])


_POINTER = ["t", "l", "i", "leaves", "at", "al", "ai", "aleaves", "path"]


def _jump(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows pointing twice as far: the path of the node they point at follows their own.
    Rows that point at the root stay."""
    copies = lambda leaves: F.ceil(F.col(leaves) / float(SALT_ROWS)).cast("long")
    far = nodes.select(
        F.col("t").alias("jt"), F.col("l").alias("jl"), F.col("i").alias("ji"),
        F.explode(F.sequence(F.lit(0).cast("long"), copies("leaves") - 1)).alias("salt"),
        *[F.col(c).alias(f"j_{c}") for c in ("at", "al", "ai", "aleaves", "path")])
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("t", "l", "i"), copies("aleaves")))
    met = salted.join(far, (F.col("at") == F.col("jt")) & (F.col("al") == F.col("jl")) & (F.col("ai") == F.col("ji"))
                      & (salted["salt"] == far["salt"]), "left")
    took = {c: F.coalesce(f"j_{c}", c).alias(c) for c in ("at", "al", "ai", "aleaves")}
    took["path"] = F.when(F.col("j_path").isNull(), F.col("path")).otherwise(F.concat("path", "j_path")).alias("path")
    return met.select(*[took.get(c, F.col(c)) for c in rows.columns])


def manifest(rows: DataFrame, scratch: Scratch, *, fields: Sequence[str] = FIELDS, tree: str = "lang",
             order: str = "doc_id", fanout: int = FANOUT, keep: Mapping[str, Column] | None = None) -> Manifest:
    """The manifest of a table; ``keep`` names small columns (any expression) to carry to the proofs.

    Nulls: a null field is encoded apart from every value; rows whose tree is null
    form a tree of their own, the first; a null order value comes first.  Rows with
    equal order ascend by digest, and equal rows are leaves of their own.  A tree of
    one leaf has that leaf as subroot; a run of one node is hashed like any other.
    No rows: no root, empty tables.  Other columns play no part.
    """
    keep = dict(keep or {})
    carry = [f"k_{n}" for n in keep]
    leaves = rows.select(F.col(tree).alias("tree"), F.col(order).alias("key"),
                         F.unhex(leaf_digest([F.col(f) for f in fields])).alias("digest"),
                         *[c.alias(f"k_{n}") for n, c in keep.items()])
    placed, trees = _placed(leaves, scratch)
    largest, n_trees = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    bottom, top = _height(largest or 0, fanout), _height(n_trees, fanout)

    # Level by level: the runs, and the nodes that they become.  Each level is an eighth of the one before it.
    def rise(nodes: DataFrame, height: int, cols: Sequence[str]) -> tuple[list[DataFrame], list[DataFrame]]:
        runs, ends = [], [nodes.where(F.col("n") == 1).select("t", "digest", "leaves")]
        for level in range(height):
            runs.append(scratch.cut(_runs(nodes, fanout, cols if level == 0 else ()), f"merkle-runs-{level}"))
            nodes = _parents(runs[-1], fanout)
            ends.append(nodes.where(F.col("n") == 1).select("t", "digest", "leaves"))
        return runs, ends

    kept = [*carry, "tree"]
    ground = placed.withColumn("leaves", F.lit(1).cast("long"))
    runs, ends = rise(ground, bottom, kept)
    subroots = ends[0]
    for more in ends[1:]:
        subroots = subroots.unionByName(more)
    subroots = scratch.cut(subroots.withColumnRenamed("leaves", "n_leaves"), "merkle-subroots")
    roots, last = rise(subroots.select(F.lit(_TOP).cast("long").alias("t"), F.col("t").alias("i"),
                                       F.lit(n_trees).cast("long").alias("n"), "digest", F.col("n_leaves").alias("leaves")), top, ())
    found = last[top].select(_text(F.col("digest"))).first() if n_trees else None

    # One step for every node: leaves apart (they are never pointed at), inner nodes and subroots together.
    single = ground.where(F.col("n") == 1).select(
        "t", F.lit(0).alias("l"), "i", "leaves", "n", F.lit(_TOP).cast("long").alias("at"), F.lit(0).alias("al"),
        F.col("t").alias("ai"), F.lit(1).cast("long").alias("aleaves"), "digest",
        F.array().cast("array<struct<left:binary,right:binary>>").alias("path"), *kept)
    proofs = single
    if runs:
        proofs = _pointers(runs[0], 0, fanout, kept).unionByName(single)
    inner = None
    for level, of in [*enumerate(runs[1:], 1), *enumerate(roots)]:
        part = _pointers(of, level, fanout, ()).select(*_POINTER)
        inner = part if inner is None else inner.unionByName(part)
    if inner is not None:
        nodes, reach = scratch.cut(inner, "merkle-pointers-1"), 1
        while reach < bottom + top:
            proofs, reach = _jump(proofs, nodes), 2 * reach
            if reach < bottom + top:
                nodes = scratch.cut(_jump(nodes, nodes), f"merkle-pointers-{reach}")
    leaf = _text(F.col("digest"))
    names = {f"k_{n}": n for n in keep}
    proofs = proofs.select(
        *[F.col(c).alias(names[c]) for c in carry], "tree", F.col("i").alias("place"), leaf.alias("leaf"),
        fold(leaf, F.slice("path", F.lit(1), levels(F.col("n"), fanout))).alias("subroot"), "path")
    listed = subroots.join(trees.select("tree", "t"), "t").select("tree", "n_leaves", _text(F.col("digest")).alias("subroot"))
    return Manifest(None if found is None else found[0], listed, proofs)
