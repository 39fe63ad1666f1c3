"""Rows that a ledger run leaves out (K4), kept beside those it takes.

Three kinds of rows vanish from the ledger without a word: cashflows of a treaty
that the master lacks, movements of a GoC that the master lacks, and movements of
a GoC that never had an INIT_RECOG.  Here the same joins are made as outer joins
and the same windows without their filter, every row carries the reason it is
left out (or none), and the caller writes both kinds in one job and counts them
while writing: no second scan, no anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gocledger import schema as S

#: Why a row is left out; TAKEN rows are not.
TAKEN, NO_TREATY, NO_GOC, NO_INIT = "TAKEN", "NO_TREATY", "NO_GOC", "NO_INIT_RECOG"
REASONS = (NO_TREATY, NO_GOC, NO_INIT)


def flagged_treaty_movement(stg_cashflow: DataFrame, stg_treaty: DataFrame) -> DataFrame:
    """M1 with the cashflows of unknown treaties, and ``reason``."""
    treaties = stg_treaty.select("treaty_id", "treaty_type", "goc_id", F.lit(True).alias("_known"))
    joined = stg_cashflow.join(treaties, "treaty_id", "left")
    return joined.select("treaty_id", "goc_id", "treaty_type", "reporting_date", "reporting_quarter", "aoc_step", "amount",
                         F.when(F.col("_known"), F.lit(TAKEN)).otherwise(F.lit(NO_TREATY)).alias("reason"))


def flagged_goc_movement(treaty_movement: DataFrame, stg_goc: DataFrame) -> DataFrame:
    """M2 with the movements of unknown GoCs and of GoCs without INIT_RECOG, and ``reason``."""
    per_goc = treaty_movement.groupBy("goc_id", "reporting_date", "reporting_quarter", "aoc_step").agg(
        F.sum("amount").alias("amount"), F.countDistinct("treaty_id").alias("treaty_count"))
    gocs = stg_goc.select("goc_id", "goc_type", F.lit(True).alias("_known"))
    any_init = F.max((F.col("aoc_step") == S.INIT_RECOG).cast("int")).over(Window.partitionBy("goc_id"))
    reason = (F.when(F.col("_known").isNull(), F.lit(NO_GOC)).when(any_init != 1, F.lit(NO_INIT)).otherwise(F.lit(TAKEN)))
    return per_goc.join(gocs, "goc_id", "left").select(
        "goc_id", "goc_type", "reporting_date", "reporting_quarter", "aoc_step", "amount", "treaty_count", reason.alias("reason"))


def counts() -> list[Column]:
    """What to observe while flagged rows are written."""
    return [F.count(F.when(F.col("reason") == r, F.lit(1))).alias(r) for r in (TAKEN, *REASONS)]


def rejected(treaty_rows: DataFrame, goc_rows: DataFrame) -> DataFrame:
    """(reason, level, treaty_id, goc_id, reporting_date, aoc_step, amount) of all rows left out."""
    amount = F.col("amount").cast("decimal(28,2)").alias("amount")
    left = F.col("reason") != TAKEN
    return treaty_rows.where(left).select(
        "reason", F.lit("TREATY").alias("level"), "treaty_id", "goc_id", "reporting_date", "aoc_step", amount).unionByName(
        goc_rows.where(left).select(
            "reason", F.lit("GOC").alias("level"), F.lit(None).cast("string").alias("treaty_id"), "goc_id", "reporting_date",
            "aoc_step", amount))
