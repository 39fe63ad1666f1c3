"""Mixing sources to target weights by Efraimidis-Spirakis sampling, DataFrame operations only.

Every document draws an exponential key, ``-ln(u) / quality weight`` with ``u``
from a seeded hash of the document; in key order the documents of a source are a
weighted sample without replacement of any prefix length.  A source's token
target is met by complete epochs of the source first, then by the prefix of the
key order whose size comes nearest to what is left.

The prefix sums never gather a source: rows fall into key ranges ("bins", about
the square root of the row count), bins are pre-aggregated before the shuffle, a
window over the bins finds the range in which the budget ends, and only that
range's rows are sorted.  The decision is one key threshold per source, so it is
applied to the documents without moving their texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gocledger.llm.common import Scratch

SEED = 8
SHARE = 1.5
MOST = 2
#: Weights of the sources in code-point order, repeating.
SOURCE_WEIGHTS = (5.0, 2.0, 1.0)
#: Quality weight of a document by its label: good, bad, unlabelled.
GOOD, BAD, UNKNOWN = 1.0, 0.25, 0.5

WORDS = r"[^ \t-\r]+"


def word_count(text: Column) -> Column:
    """Number of words of a whole text (null: 0); words are what ASCII white space separates."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def uniform(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """In (0, 1), decided by the document alone: 52 bits of an MD5 of seed, doc_id and text."""
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"),
                   F.coalesce(F.md5(text), F.lit("")))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def with_quality(docs: DataFrame, labels: DataFrame | None, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` plus ``__w``: the weight of the document's label.  Repeated labels count
    once (the best quality); a null or absent label, or no labels at all: UNKNOWN."""
    if labels is None:
        return docs.withColumn("__w", F.lit(UNKNOWN))
    one = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id")).agg(F.max("quality").alias("__q"))
    w = F.when(F.col("__q") == 1, F.lit(GOOD)).when(F.col("__q") == 0, F.lit(BAD)).otherwise(F.lit(UNKNOWN))
    return docs.join(one, docs[doc_id] == F.col("__id"), "left").withColumn("__w", w).drop("__id", "__q")


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST,
            weights: tuple[float, ...] = SOURCE_WEIGHTS) -> DataFrame:
    """(source, source_size) -> plus target: ``share`` of all sizes dealt by weight, no source
    above ``most`` times its size, the excess dealt again by weight until none is above.

    Sources take their weights in code-point order, null last.  The dealing has a
    closed form: in order of most*size/weight the full sources are a prefix, and
    all others get the same amount per unit of weight.  One row per source.
    """
    if not 0 < share <= most:
        raise ValueError("share must be above 0 and at most `most`")
    every = Window.partitionBy()
    ranked = sizes.withColumn("__rank", F.row_number().over(every.orderBy(F.col("source").isNull(), F.col("source"))))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("__rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    full = ranked.withColumns({"__wt": w, "__cap": F.col("source_size") * F.lit(float(most))})
    order = every.orderBy(F.col("__cap") / F.col("__wt"), "__rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = full.withColumns({
        "__money": F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)),
        "__heads": F.sum("__wt").over(every) - F.coalesce(F.sum("__wt").over(before), F.lit(0.0)),
    })
    rate = F.min(F.when(F.col("__cap") / F.col("__wt") > F.col("__money") / F.col("__heads"),
                        F.struct(F.col("__cap") / F.col("__wt"), F.col("__rank"), F.col("__money") / F.col("__heads")))).over(every)
    return left.withColumn("__rate", rate["col3"]).select(
        "source", "source_size",
        F.least("__cap", F.coalesce(F.col("__rate") * F.col("__wt"), F.col("__cap"))).alias("target"))


def thresholds(rows: DataFrame, goals: DataFrame, n_rows: int, scratch: Scratch) -> DataFrame:
    """Per source: epochs (long) and last_key (double; null: no fractional part);
    at_included tells whether the key itself is taken.

    ``rows``: source, size, key, w.  ``goals``: source, source_size, target.  The
    key ranges where budgets end are written first (one row per source), so that
    Spark knows their size and need not shuffle the rows to meet them.
    """
    bins = max(1, math.isqrt(n_rows))
    mean = rows.agg(F.avg("w").alias("w")).first()["w"] or 1.0
    binned = rows.withColumn("bin", F.floor((1.0 - F.exp(-F.col("key") * F.lit(mean))) * bins))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("epochs", whole).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    g = goals.select(F.col("source").alias("__src"), "epochs", "rest")
    per_bin = binned.groupBy("source", "bin").agg(F.sum("size").alias("n"))
    ahead = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    run = per_bin.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    last = (run.join(g, run["source"].eqNullSafe(g["__src"]))
            .where((F.col("ahead") < F.col("rest")) & (F.col("ahead") + F.col("n") >= F.col("rest")))
            .select(F.col("__src"), F.col("bin").alias("__bin"), F.col("ahead"), F.col("rest")))
    last = scratch.cut(last, "mix-last-bins")
    edge = (binned.join(last, binned["source"].eqNullSafe(last["__src"]) & (binned["bin"] == last["__bin"]))
            .groupBy("source", "ahead", "rest", "key").agg(F.sum("size").alias("n")))
    by_key = Window.partitionBy("source").orderBy("key")
    upto = F.col("ahead") + F.sum("n").over(by_key.rowsBetween(Window.unboundedPreceding, 0))
    prior = F.lag("key").over(by_key)
    steps = edge.select("source", "key", "rest", upto.alias("upto"), (upto - F.col("n")).alias("under"), prior.alias("prior"))
    cut = (steps.where((F.col("under") < F.col("rest")) & (F.col("upto") >= F.col("rest")))
           .select(F.col("source").alias("__cut"), F.when(F.col("upto") - F.col("rest") <= F.col("rest") - F.col("under"), F.col("key"))
                   .otherwise(F.col("prior")).alias("in_bin"), F.col("key").alias("at")))
    # Nothing of the last bin taken: the threshold is just below its first key.
    out = goals.join(cut, goals["source"].eqNullSafe(cut["__cut"]), "left")
    return out.select("source", "source_size", "target", "epochs",
                      F.coalesce("in_bin", "at").alias("last_key"),
                      F.col("in_bin").isNotNull().alias("at_included"))


def mix(docs: DataFrame, labels: DataFrame | None, scratch: Scratch, *, share: float = SHARE, most: float = MOST,
        weights: tuple[float, ...] = SOURCE_WEIGHTS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text",
        source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(plan, rows): per source its size, target, epochs and key threshold; per document
    doc_id, source, size, key and copies (how often the mix takes it).

    Null texts have size 0; a null source is a source of its own; a null doc_id
    draws by its text.  Rows equal in doc_id and text draw the same key and are
    taken or left together.  No rows: both results are empty.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                       word_count(F.col(text)).alias("size"), uniform(F.col(doc_id), F.col(text), seed).alias("u"))
    keyed = with_quality(base, labels).select("doc_id", "source", "size", F.col("__w").alias("w"),
                                              (-F.log("u") / F.col("__w")).alias("key"))
    rows, n = scratch.cut_counted(keyed, "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = scratch.cut(targets(sizes, share, most, weights), "mix-targets")
    plan = scratch.cut(thresholds(rows, goals, n, scratch), "mix-plan")
    p = plan.select(F.col("source").alias("__src"), "source_size", "target", "epochs", "last_key", "at_included")
    taken = rows.join(p, rows["source"].eqNullSafe(p["__src"]))
    return plan, taken.select("doc_id", "source", "size", "key", "source_size", "target", copies(F.col("key")).alias("copies"))


def copies(key: Column) -> Column:
    """How often a document with this key is taken under its source's plan row."""
    inside = (key < F.col("last_key")) | ((key == F.col("last_key")) & F.col("at_included"))
    return F.col("epochs") + F.coalesce(inside, F.lit(False)).cast("long")


def apply_mix(docs: DataFrame, labels: DataFrame | None, scratch: Scratch, **options) -> DataFrame:
    """The mixed corpus: ``docs`` with every row repeated as often as the mix takes it.

    The plan has one row per source; keys are drawn again from the documents, so
    texts are not shuffled to meet their decision unless Spark joins the labels
    by a shuffle.
    """
    plan, _ = mix(docs, labels, scratch, **options)
    doc_id, text, source = (options.get(k, k) for k in ("doc_id", "text", "source"))
    p = plan.select(F.col("source").alias("__src"), "epochs", "last_key", "at_included")
    names = docs.columns
    drawn = with_quality(docs.withColumn("__u", uniform(F.col(doc_id), F.col(text), options.get("seed", SEED))), labels, doc_id)
    drawn = drawn.select(*names, (-F.log("__u") / F.col("__w")).alias("__key"))
    plan_names = {c: f"__{c}" for c in ("epochs", "last_key", "at_included")}
    p = p.withColumnsRenamed(plan_names)
    inside = (F.col("__key") < F.col("__last_key")) | ((F.col("__key") == F.col("__last_key")) & F.col("__at_included"))
    n = F.col("__epochs") + F.coalesce(inside, F.lit(False)).cast("long")
    met = drawn.join(p, drawn[source].eqNullSafe(p["__src"])).withColumn("__n", n).where(F.col("__n") > 0)
    return met.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n")))).select(*names)
