"""Scenario walk-through queries (N1, N2) over the raw inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gocledger import schema as S
from gocledger.functions import state_of


def _assumed_cashflows(cashflow: DataFrame, treaty: DataFrame) -> DataFrame:
    t = treaty.filter(F.col("treaty_type") == S.ASSUMED).select("treaty_id", "goc_id")
    return cashflow.select("treaty_id", "reporting_date", "aoc_step", "amount").join(t, "treaty_id", "inner")


def verify_goc_cashflow(cashflow: DataFrame, treaty: DataFrame, goc: DataFrame, ordered: bool = False) -> DataFrame:
    """Assumed cashflow totals per GoC x step x date, with the scenario labels.

    Treaty rows are summed per GoC *before* the GoC labels are attached, so the
    join sees one row per GoC x step x date."""
    per_goc = _assumed_cashflows(cashflow, treaty).groupBy("goc_id", "aoc_step", "reporting_date").agg(
        F.sum("amount").alias("total_amount"))
    labels = goc.select("goc_id", "expected_initial_state", "scenario_description")
    out = per_goc.join(labels, "goc_id", "inner").select(
        "goc_id", "expected_initial_state", "scenario_description", "aoc_step", "reporting_date",
        F.col("total_amount").cast(S.MONEY).alias("total_amount"))
    return out.orderBy("goc_id", "reporting_date", "aoc_step") if ordered else out


def verify_cumulative_state(cashflow: DataFrame, treaty: DataFrame, ordered: bool = False) -> DataFrame:
    """Quarterly totals per GoC (INIT_RECOG and VARIANCE merged), their
    running cumulative and the state it implies."""
    q = _assumed_cashflows(cashflow, treaty).groupBy("goc_id", "reporting_date").agg(
        F.sum("amount").alias("quarterly_amount"))
    # one row per GoC x date after the grouping, so a RANGE frame equals a ROWS frame
    w = Window.partitionBy("goc_id").orderBy("reporting_date").rowsBetween(Window.unboundedPreceding, 0)
    cum = F.sum("quarterly_amount").over(w)
    out = q.select(
        "goc_id", "reporting_date",
        F.col("quarterly_amount").cast(S.MONEY).alias("quarterly_amount"),
        cum.cast(S.MONEY).alias("cumulative_balance"),
        state_of(cum).alias("expected_state"),
    )
    return out.orderBy("goc_id", "reporting_date") if ordered else out
