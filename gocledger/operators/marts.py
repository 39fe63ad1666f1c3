"""Reporting marts.

All marts read the GoC-level ledger (bounded by GoCs x periods) or aggregate
the treaty ledger with partial (map-side) aggregation before any shuffle, so
their cost is one scan of the treaty ledger at most.  Row order is a
presentation concern: pass ``ordered=True`` to get the published sort, leave it
off when writing a table (an ORDER BY is no stored guarantee and costs a
range-partitioning shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gocledger import schema as S
from gocledger.functions import aoc_order, money

_GOC_AOC_COLS = (
    "goc_id", "goc_type", "scenario_description", "reporting_date", "reporting_quarter", "aoc_step",
    "aoc_order", "cf_amount", "cf_cumulative", "csm_amount", "lc_amount", "lrc_amount",
    "profitability_state",
)


def _null_money() -> F.Column:
    return F.lit(None).cast(S.MONEY)


def _zero_money() -> F.Column:
    return F.lit(0).cast(S.MONEY)


def goc_csm_release(treaty_state: DataFrame) -> DataFrame:
    """A2: non-zero treaty releases rolled up to GoC x date."""
    rel = treaty_state.filter((F.col("aoc_step") == S.CSM_RELEASE) & (F.col("csm_amount") != 0))
    return rel.groupBy("goc_id", "reporting_date", "reporting_quarter").agg(
        F.sum("csm_amount").alias("csm_amount"),
        F.max("profitability_state").alias("profitability_state"),
    )


def mart_goc_aoc_quarterly(goc_state: DataFrame, treaty_state: DataFrame, retro_state: DataFrame,
                           stg_goc: DataFrame, ordered: bool = False) -> DataFrame:
    """A1-A3: assumed GoC ledger (ASSUMED GoCs only), non-zero releases rolled up
    to GoC, and retro GoC recovery rows — unioned first and joined to the GoC
    dimension once (inner join: rows of unknown GoCs drop out)."""
    assumed = goc_state.select(
        F.lit(True).alias("_assumed_only"), "goc_id", "reporting_date", "reporting_quarter", "aoc_step",
        "aoc_order", "cf_amount", "cf_cumulative", "csm_amount", "lc_amount",
        _null_money().alias("lrc_amount"), "profitability_state",
    )
    release = goc_csm_release(treaty_state).select(
        F.lit(False).alias("_assumed_only"), "goc_id", "reporting_date", "reporting_quarter",
        F.lit(S.CSM_RELEASE).alias("aoc_step"), F.lit(S.AOC_ORDER[S.CSM_RELEASE]).alias("aoc_order"),
        _zero_money().alias("cf_amount"), _null_money().alias("cf_cumulative"),
        money(F.col("csm_amount")).alias("csm_amount"), _zero_money().alias("lc_amount"),
        _null_money().alias("lrc_amount"), "profitability_state",
    )
    retro = retro_state.select(
        F.lit(False).alias("_assumed_only"), F.col("retro_goc_id").alias("goc_id"), "reporting_date",
        "reporting_quarter", "aoc_step", "aoc_order", _zero_money().alias("cf_amount"),
        _null_money().alias("cf_cumulative"), "csm_amount", "lc_amount", "lrc_amount", "profitability_state",
    )
    gocs = stg_goc.select("goc_id", "goc_type", "scenario_description")
    out = (
        assumed.unionByName(release).unionByName(retro)
        .join(gocs, "goc_id", "inner")
        .filter(~F.col("_assumed_only") | (F.col("goc_type") == S.ASSUMED))
        .select(*_GOC_AOC_COLS)
    )
    return out.orderBy("goc_id", "reporting_date", "aoc_order") if ordered else out


def mart_treaty_aoc_quarterly(treaty_state: DataFrame, stg_treaty: DataFrame, ordered: bool = False) -> DataFrame:
    master = stg_treaty.select("treaty_id", "goc_id", "treaty_type")
    bs = treaty_state.select(
        "treaty_id", "reporting_date", "aoc_step", "aoc_order", "cf_amount", "csm_amount", "lc_amount",
        "profitability_state",
    ).join(master, "treaty_id", "left")
    if ordered:
        bs = bs.orderBy("treaty_id", "reporting_date", "aoc_order")
    return bs.select(
        "treaty_id", "goc_id", "treaty_type", "reporting_date", "aoc_step", "cf_amount", "csm_amount",
        "lc_amount", "profitability_state",
    )


def mart_goc_annual_summary(goc_aoc: DataFrame, ordered: bool = False) -> DataFrame:
    """A5: per GoC and year, the Q1 OPENING, the year's movements by step and the
    Q4 CLOSING, in one pass over the quarterly mart (one ``groupBy(goc_id,
    reporting_year)`` with conditional aggregates).  A GoC has a row for a year only
    when the year has all three parts (retro GoCs have no OPENING and drop out);
    ``total_lrc`` stays NULL unless a release row contributes a 0, as with the
    step-wise sums."""
    step, q = F.col("aoc_step"), F.col("reporting_quarter")
    is_open = (q == 1) & (step == S.OPENING)
    is_close = (q == 4) & (step == S.CLOSING)
    is_move = ~step.isin(S.OPENING, S.CLOSING)

    def at(cond, col):
        return F.max(F.when(cond, F.col(col)))

    def moved(steps, col):
        return money(F.sum(F.when(is_move, F.when(step.isin(*steps), F.col(col)).otherwise(_zero_money()))))

    agg = goc_aoc.groupBy("goc_id", F.year("reporting_date").alias("reporting_year")).agg(
        F.max(is_open.cast("int")).alias("_open"), F.max(is_close.cast("int")).alias("_close"),
        F.max(is_move.cast("int")).alias("_move"),
        at(is_open, "goc_type").alias("goc_type"),
        at(is_open, "scenario_description").alias("scenario_description"),
        at(is_open, "csm_amount").alias("opening_csm"), at(is_open, "lc_amount").alias("opening_lc"),
        at(is_open, "lrc_amount").alias("opening_lrc"),
        moved([S.INIT_RECOG], "csm_amount").alias("init_recog_csm"),
        moved([S.INIT_RECOG], "lc_amount").alias("init_recog_lc"),
        moved([S.VARIANCE], "csm_amount").alias("total_variance_csm"),
        moved([S.VARIANCE], "lc_amount").alias("total_variance_lc"),
        moved([S.CSM_RELEASE], "csm_amount").alias("total_csm_release"),
        moved([S.INIT_RECOG, S.VARIANCE], "lrc_amount").alias("total_lrc"),
        at(is_close, "csm_amount").alias("closing_csm"), at(is_close, "lc_amount").alias("closing_lc"),
        at(is_close, "lrc_amount").alias("closing_lrc"),
        at(is_close, "profitability_state").alias("final_profitability"),
    )
    out = agg.filter((F.col("_open") == 1) & (F.col("_close") == 1) & (F.col("_move") == 1)).select(
        "goc_id", "reporting_year", "goc_type", "scenario_description", "opening_csm", "opening_lc", "opening_lrc",
        "init_recog_csm", "init_recog_lc", "total_variance_csm", "total_variance_lc", "total_csm_release",
        "total_lrc", "closing_csm", "closing_lc", "closing_lrc", "final_profitability",
    )
    return out.orderBy("goc_id", "reporting_year") if ordered else out


def mart_annual_aoc_detail(goc_aoc: DataFrame, ordered: bool = False) -> DataFrame:
    """Per GoC, year and step, the year's sums."""
    out = goc_aoc.groupBy("goc_id", "goc_type", F.year("reporting_date").alias("reporting_year"), "aoc_step").agg(
        money(F.sum("csm_amount")).alias("annual_csm_amount"),
        money(F.sum("lc_amount")).alias("annual_lc_amount"),
        money(F.sum("lrc_amount")).alias("annual_lrc_amount"),
    )
    if ordered:
        out = out.orderBy("goc_id", "reporting_year", aoc_order(F.col("aoc_step")))
    return out


def mart_pnl_quarterly(goc_state: DataFrame, treaty_state: DataFrame, retro_state: DataFrame,
                       ordered: bool = False) -> DataFrame:
    """Per quarter with a GoC CLOSING — revenue (treaty CSM releases), service
    expense (negative VARIANCE LC of the GoCs) and recovery (retro LRC), 0 when
    absent.  One union of the three sources, partially aggregated per source, then
    one aggregation per date: no joins."""
    zero = F.lit(0).cast(S.MONEY)

    def part(df, has_quarter, rev, exp, rec):
        return df.select("reporting_date",
                         F.when(F.lit(has_quarter), F.col("reporting_quarter")).alias("q"),
                         rev.alias("rev"), exp.alias("exp"), rec.alias("rec"))

    step = F.col("aoc_step")
    quarters = part(goc_state.filter(step == S.CLOSING), True, zero, zero, zero)
    revenue = part(treaty_state.filter(step == S.CSM_RELEASE), False, F.col("csm_amount"), zero, zero)
    expense = part(goc_state.filter((step == S.VARIANCE) & (F.col("lc_amount") < 0)), False,
                   zero, F.col("lc_amount"), zero)
    recovery = part(retro_state, False, zero, zero, F.col("lrc_amount"))
    agg = quarters.unionByName(revenue).unionByName(expense).unionByName(recovery).groupBy("reporting_date").agg(
        F.max("q").alias("reporting_quarter"),
        F.sum("rev").alias("rev"), F.sum("exp").alias("exp"), F.sum("rec").alias("rec"),
    ).filter(F.col("reporting_quarter").isNotNull())
    out = agg.select(
        "reporting_date", "reporting_quarter",
        money(F.col("rev")).alias("insurance_revenue_gross"),
        money(F.col("exp")).alias("insurance_service_expense_gross"),
        money(F.col("rec")).alias("recovery_ceded"),
        money(F.col("rev") + F.col("exp") + F.col("rec")).alias("net_result"),
    )
    return out.orderBy("reporting_date") if ordered else out
