"""Invariant validators (V1-V9).  Each returns the violating rows: empty = pass.

L1 checks read the GoC ledger (small); L2 checks aggregate the treaty ledger
with partial aggregation first; the summary counts every validator in one job.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gocledger import schema as S
from gocledger.functions import money, period_index
from gocledger.params import LedgerParams

_P = LedgerParams()


def _tol(params: LedgerParams) -> F.Column:
    return F.lit(Decimal(params.tolerance))


def val_bs_invariants(goc_state: DataFrame, params: LedgerParams = _P) -> DataFrame:
    tol = _tol(params)
    csm, lc, cum, st = F.col("csm_amount"), F.col("lc_amount"), F.col("cf_cumulative"), F.col("profitability_state")
    bad = (
        ((st == S.PROFITABLE) & ((F.abs(csm + cum) > tol) | (F.abs(lc) > tol)))
        | ((st == S.ONEROUS) & ((F.abs(csm) > tol) | (F.abs(lc - cum) > tol)))
        | ((st == S.BREAK_EVEN) & ((F.abs(csm) > tol) | (F.abs(lc) > tol)))
    )
    return goc_state.filter((F.col("aoc_step") == S.CLOSING) & bad).select(
        "goc_id", "reporting_date", "cf_cumulative", "csm_amount", "lc_amount", "profitability_state")


def val_profitability_consistency(goc_state: DataFrame, params: LedgerParams = _P) -> DataFrame:
    tol = _tol(params)
    st = F.col("profitability_state")
    bad = ((st == S.PROFITABLE) & (F.abs(F.col("lc_amount")) > tol)) | (
        (st == S.ONEROUS) & (F.abs(F.col("csm_amount")) > tol))
    return goc_state.filter((F.col("aoc_step") == S.CLOSING) & bad).select(
        "goc_id", "reporting_date", "aoc_step", "profitability_state", "csm_amount", "lc_amount")


def val_rollforward_continuity(goc_state: DataFrame, params: LedgerParams = _P) -> DataFrame:
    """Every roll-forward OPENING equals the previous quarter's CLOSING.

    First OPENINGs (zeros on the INIT_RECOG date, NULL state) are not
    roll-forwards and are skipped; quarters are matched as absolute quarters.
    """
    tol = _tol(params)
    openings = goc_state.filter(
        (F.col("aoc_step") == S.OPENING) & F.col("profitability_state").isNotNull()
    ).select(
        "goc_id",
        F.col("reporting_date").alias("opening_date"),
        F.col("reporting_quarter").alias("opening_quarter"),
        (period_index(F.col("reporting_date")) - 1).alias("_pidx"),
        F.col("csm_amount").alias("opening_csm"),
        F.col("lc_amount").alias("opening_lc"),
    )
    closings = goc_state.filter(F.col("aoc_step") == S.CLOSING).select(
        "goc_id",
        F.col("reporting_date").alias("closing_date"),
        F.col("reporting_quarter").alias("closing_quarter"),
        period_index(F.col("reporting_date")).alias("_pidx"),
        F.col("csm_amount").alias("prev_closing_csm"),
        F.col("lc_amount").alias("prev_closing_lc"),
    )
    paired = openings.join(closings, ["goc_id", "_pidx"], "inner")
    return paired.filter(
        (F.abs(F.col("opening_csm") - F.col("prev_closing_csm")) > tol)
        | (F.abs(F.col("opening_lc") - F.col("prev_closing_lc")) > tol)
    ).select("goc_id", "opening_date", "opening_quarter", "closing_date", "closing_quarter",
             "opening_csm", "prev_closing_csm", "opening_lc", "prev_closing_lc")


def val_retro_recovery_identity(retro_movement: DataFrame, params: LedgerParams = _P) -> DataFrame:
    expected = F.abs(F.col("assumed_lc_amount")) * F.col("retro_cession_rate")
    return retro_movement.filter(F.abs(F.col("lrc_amount") - expected) > _tol(params)).select(
        "retro_treaty_id", "assumed_treaty_id", "reporting_date", "aoc_step", "assumed_lc_amount",
        "retro_cession_rate", "lrc_amount", expected.alias("expected_lrc"))


def val_release_timing(treaty_state: DataFrame, params: LedgerParams = _P) -> DataFrame:
    tol = _tol(params)
    bad = (
        ~F.col("reporting_quarter").isin(*sorted(params.release_ratios))
        | ((F.col("profitability_state") == S.ONEROUS) & (F.abs(F.col("csm_amount")) > tol))
        | (F.abs(F.col("cf_amount")) > tol)
    )
    return treaty_state.filter((F.col("aoc_step") == S.CSM_RELEASE) & bad).select(
        "treaty_id", "reporting_date", "reporting_quarter", "profitability_state", "csm_amount", "cf_amount")


def val_treaty_goc_reconciliation(treaty_state: DataFrame, goc_state: DataFrame,
                                  params: LedgerParams = _P) -> DataFrame:
    tol = _tol(params)
    sums = treaty_state.filter(~F.col("aoc_step").isin(S.CSM_RELEASE, S.CLOSING)).groupBy(
        "goc_id", "reporting_date", "aoc_step").agg(
        F.sum("csm_amount").alias("treaty_csm_total"), F.sum("lc_amount").alias("treaty_lc_total"))
    goc = goc_state.select("goc_id", "reporting_date", "aoc_step",
                           F.col("csm_amount").alias("goc_csm"), F.col("lc_amount").alias("goc_lc"))
    j = sums.join(goc, ["goc_id", "reporting_date", "aoc_step"], "inner")
    return j.filter(
        (F.abs(F.col("treaty_csm_total") - F.col("goc_csm")) > tol)
        | (F.abs(F.col("treaty_lc_total") - F.col("goc_lc")) > tol)
    ).select("goc_id", "reporting_date", "aoc_step", money(F.col("treaty_csm_total")).alias("treaty_csm_total"),
             "goc_csm", money(F.col("treaty_lc_total")).alias("treaty_lc_total"), "goc_lc")


def val_retro_no_double_recovery(retro_movement: DataFrame, params: LedgerParams = _P) -> DataFrame:
    agg = retro_movement.groupBy("retro_goc_id", "retro_treaty_id", "assumed_treaty_id").agg(
        F.sum("lrc_amount").alias("total_recovery"),
        (F.sum(F.abs(F.col("assumed_lc_amount"))) * F.max("retro_cession_rate")).alias("max_allowed_recovery"),
    )
    return agg.filter(F.col("total_recovery") > F.col("max_allowed_recovery") + _tol(params)).select(
        "retro_goc_id", "retro_treaty_id", "assumed_treaty_id",
        F.col("total_recovery").cast("decimal(38,4)").alias("total_recovery"),
        F.col("max_allowed_recovery").cast("decimal(38,4)").alias("max_allowed_recovery"),
    )


def val_scenario_expectation(stg_goc: DataFrame, goc_state: DataFrame, expectations: DataFrame) -> DataFrame:
    """Assumed GoCs whose state at the last CLOSING date differs from the
    expected final state given in ``expectations`` (goc_id, expected_final_state)."""
    closing = goc_state.filter(F.col("aoc_step") == S.CLOSING)
    last = closing.agg(F.max("reporting_date").alias("reporting_date"))
    final = closing.join(last, "reporting_date", "inner").select(
        "goc_id", F.col("profitability_state").alias("actual_final_state"))
    gocs = stg_goc.filter(F.col("goc_type") == S.ASSUMED).select(
        "goc_id", "expected_initial_state", "scenario_description")
    j = gocs.join(final, "goc_id", "inner").join(expectations, "goc_id", "inner")
    return j.filter(F.col("actual_final_state") != F.col("expected_final_state")).select(
        "goc_id", "expected_initial_state", "scenario_description", "actual_final_state")


VALIDATORS = (
    "val_bs_invariants",
    "val_profitability_consistency",
    "val_rollforward_continuity",
    "val_retro_recovery_identity",
    "val_release_timing",
    "val_treaty_goc_reconciliation",
    "val_retro_no_double_recovery",
    "val_scenario_expectation",
)


def val_summary(results: dict[str, DataFrame]) -> DataFrame:
    """(validation, fail_count) for every validator, zero counts included."""
    parts = [
        results[name].groupBy().agg(F.count(F.lit(1)).alias("fail_count"))
        .select(F.lit(name).alias("validation"), "fail_count")
        for name in VALIDATORS
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
