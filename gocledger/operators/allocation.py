"""Allocation to the cent (T8): a GoC step's amount handed out to its treaties without a cent over.

Pro-rata shares have six decimals; cast to cents one by one their sum misses the
GoC amount.  By the method of largest remainders every treaty gets its share
rounded down, and the cents that are left go, one each, to the treaties with the
largest remainders (where rounding has made the shares too large in sum, cents are
taken back from the smallest).

No GoC has to fit into one task.  A remainder is one of 10,000 values, so counting
treaties by (GoC, date, step, remainder) combines map-side, and running counts over
those few rows name the remainder at which the cents run out: all above it get one,
all below none.  Treaties *at* it are counted by the first digits of the md5 of
their id in the same way; only those of the one digit group where the cents run out
are ranked, a 65,536th of the tied treaties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gocledger.functions import precise

#: Steps of a cent that a share at six decimals can have.
_PARTS = 10_000


def to_the_cent(rows: DataFrame, shares: dict[str, str], keys: Sequence[str], entity: str) -> DataFrame:
    """``rows`` with every share (column -> column of the amount to hand out, equal within ``keys``)
    replaced by whole cents whose sum within ``keys`` is that amount.

    Rows with a null share take no part and stay null.  Ties go by md5 of ``entity`` and
    then by itself; it must tell the rows of a key apart.  An amount is handed out only
    where shares of it exist; an amount of 0 hands out zeros in sum."""
    for share, amount in shares.items():
        rows = _one(rows, share, amount, list(keys), entity)
    return rows


def _running(df: DataFrame, keys: list[str], by: str, what: str) -> Column:
    """Sum of ``what`` over all rows of the key with a greater ``by``."""
    w = Window.partitionBy(*keys).orderBy(F.desc(by)).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(what).over(w), F.lit(0))


def _one(rows: DataFrame, share: str, amount: str, keys: list[str], entity: str) -> DataFrame:
    cents = precise(F.col(share)) * 100
    low = F.floor(cents)
    part = F.floor((cents - low) * _PARTS).cast("long")
    digits = F.conv(F.substring(F.md5(F.col(entity).cast("binary")), 1, 4), 16, 10).cast("int")
    own = rows.withColumns({"_low": low.cast("decimal(38,0)"), "_part": part, "_digits": digits})

    # By remainder: at most 10,000 rows a key, however many treaties it has.
    by_part = own.where(F.col(share).isNotNull()).groupBy(*keys, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_low").alias("_sum"), F.max(amount).alias("_amount"))
    whole = Window.partitionBy(*keys)
    left = F.col("_amount").cast("decimal(38,2)") * 100 - F.sum("_sum").over(whole)
    by_part = by_part.select(*keys, "_part", "_n", left.cast("long").alias("_left"), F.sum("_n").over(whole).alias("_all"))
    # Whole cents for all first (none, or one less where the shares are too large in sum), then the rest one each.
    base = F.floor(F.col("_left") / F.col("_all")).cast("long")
    by_part = by_part.select(*keys, "_part", "_n", base.alias("_base"), (F.col("_left") - base * F.col("_all")).alias("_spare"))
    ahead = by_part.withColumn("_ahead", _running(by_part, keys, "_part", "_n"))
    edge = ahead.where((F.col("_ahead") < F.col("_spare")) & (F.col("_ahead") + F.col("_n") >= F.col("_spare")))
    edge = edge.select(*keys, "_base", F.col("_part").alias("_edge"), (F.col("_spare") - F.col("_ahead")).alias("_open"))
    none = ahead.where(F.col("_spare") <= 0).groupBy(*keys).agg(
        F.max("_base").alias("_base"), F.lit(_PARTS).cast("long").alias("_edge"), F.lit(0).cast("long").alias("_open"))
    edge = edge.unionByName(none)

    # Treaties at that remainder, by the digits of their hash.
    same = lambda a, b: [a[k].eqNullSafe(b[f"_k_{k}"]) for k in keys]
    named = lambda df: df.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    dropped = [f"_k_{k}" for k in keys]
    on_edge = named(edge)
    met = own.join(on_edge, [*same(own, on_edge)], "left").drop(*dropped)
    tied = met.where((F.col("_part") == F.col("_edge")) & (F.col("_open") > 0)).groupBy(*keys, "_digits").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_open").alias("_open"))
    ahead = tied.withColumn("_ahead", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*keys).orderBy("_digits").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    group = ahead.where((F.col("_ahead") < F.col("_open")) & (F.col("_ahead") + F.col("_n") >= F.col("_open"))).select(
        *keys, F.col("_digits").alias("_group"), (F.col("_open") - F.col("_ahead")).alias("_last"))
    on_group = named(group)
    met = met.join(on_group, [*same(met, on_group)], "left").drop(*dropped)
    ranked = (F.col("_part") == F.col("_edge")) & (F.col("_digits") == F.col("_group"))
    # Only the rows of one digit group are ranked against each other; all others are spread by their own digits and id.
    order = Window.partitionBy(*keys, F.when(ranked, F.lit(-1)).otherwise(F.xxhash64(entity))).orderBy(
        F.md5(F.col(entity).cast("binary")), entity)
    met = met.withColumn("_rank", F.row_number().over(order))
    extra = (F.when(F.col("_part") > F.col("_edge"), 1)
             .when((F.col("_part") < F.col("_edge")) | (F.col("_open") == 0), 0)
             .when(F.col("_digits") != F.col("_group"), (F.col("_digits") < F.col("_group")).cast("int"))
             .otherwise((F.col("_rank") <= F.col("_last")).cast("int")))
    made = precise((F.col("_low") + F.col("_base") + extra) / 100)
    return met.withColumn(share, F.when(F.col(share).isNull(), F.col(share)).otherwise(made)).drop(
        "_low", "_part", "_digits", "_base", "_edge", "_open", "_group", "_last", "_rank")
