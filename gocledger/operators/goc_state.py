"""GoC balance-sheet state.

The sequential profitability determination is memoryless: the state after a
movement depends only on the sign of the running cumulative.  So the whole GoC
ledger is one running sum per GoC plus closed-form column expressions; there is
no recursion and no self-join.

Plan: M2 rows (GoC x date x step, already tiny) are pivoted to one *wide* row
per GoC x period (INIT and VARIANCE amounts side by side), one window per GoC
gives the running cumulative at the start, middle (after INIT) and end of each
period and the previous period (for the roll-forward OPENING), and the four
output steps are produced by exploding an array of structs — no union, no
shuffle beyond the single window exchange.

Semantics kept from the measured model:

* a GoC without any INIT_RECOG has no state at all;
* a zero cumulative is BREAK_EVEN, and BREAK_EVEN behaves like PROFITABLE as a
  previous state (the closed form does that by itself);
* the first OPENING of a GoC sits on its INIT_RECOG date with zeros and a NULL
  state; later OPENINGs repeat the previous period's closing cumulative, but only
  when the previous quarter has a VARIANCE (a gap quarter breaks the chain);
* CLOSING exists for every period with a VARIANCE; its ``cf_amount`` is the sum
  of the period's movements.

Generalisations (identical on one year with INIT_RECOG in Q1): periods are
absolute quarters ``year*4+quarter`` so roll-forward works across year ends; the
running sum is ordered by (date, step order) so a late INIT_RECOG adds only from
its own period on; one CLOSING and one OPENING per GoC x period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gocledger import schema as S
from gocledger.functions import (
    csm_balance,
    csm_movement,
    lc_balance,
    lc_movement,
    money,
    period_index,
    state_of,
)

_STEP_FIELDS = ("aoc_step", "aoc_order", "cf_amount", "cf_cumulative", "csm_amount", "lc_amount",
                "profitability_state")


def goc_periods(goc_movement: DataFrame) -> DataFrame:
    """One row per GoC x period with every value the GoC ledger and the treaty
    push-down need (the *wide* GoC state).  GoCs without INIT_RECOG are dropped.

    The previous period's closing cumulative is this period's starting
    cumulative, so the previous-period snapshot (used by roll-forward OPENINGs
    at GoC and treaty level) needs no lag of a window column."""
    step = F.col("aoc_step")
    wide = goc_movement.groupBy("goc_id", "goc_type", "reporting_date", "reporting_quarter").agg(
        F.sum(F.when(step == S.INIT_RECOG, F.col("amount"))).alias("init_cf"),
        F.sum(F.when(step == S.VARIANCE, F.col("amount"))).alias("var_cf"),
        F.max((step == S.INIT_RECOG).cast("int")).alias("_init_n"),
        F.max((step == S.VARIANCE).cast("int")).alias("_var_n"),
    )
    init_amt = F.coalesce(F.col("init_cf"), F.lit(0))
    var_amt = F.coalesce(F.col("var_cf"), F.lit(0))
    pidx = period_index(F.col("reporting_date"))

    by_goc = Window.partitionBy("goc_id")
    ordered = by_goc.orderBy("reporting_date")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wide = wide.select(
        "*",
        pidx.alias("period_idx"),
        F.sum(init_amt + var_amt).over(running).alias("cum_end"),
        F.max(F.col("_init_n")).over(by_goc).alias("_any_init"),
        (pidx - F.lag(pidx).over(ordered)).alias("_gap"),
        F.lag(F.col("_var_n")).over(ordered).alias("_prev_var_n"),
    ).filter(F.col("_any_init") == 1)

    has_var = F.col("_var_n") == 1
    cum_end = F.col("cum_end")
    cum_start = cum_end - init_amt - var_amt
    cum_mid = cum_start + init_amt
    # the previous quarter closed (had a VARIANCE) — the roll-forward condition
    prev_closed = F.coalesce((F.col("_gap") == 1) & (F.col("_prev_var_n") == 1), F.lit(False))
    return wide.select(
        "goc_id", "goc_type", "reporting_date", "reporting_quarter", "period_idx",
        (F.col("_init_n") == 1).alias("has_init"),
        has_var.alias("has_var"),
        (has_var & prev_closed).alias("has_rollforward"),
        prev_closed.alias("prev_closed"),
        cum_start.alias("prev_cum"),
        csm_balance(cum_start).alias("prev_csm"),
        state_of(cum_start).alias("prev_state"),
        # INIT_RECOG step
        F.col("init_cf"),
        cum_mid.alias("init_cum"),
        csm_movement(cum_start, cum_mid).alias("init_csm"),
        lc_movement(cum_start, cum_mid).alias("init_lc"),
        state_of(cum_mid).alias("init_state"),
        # VARIANCE step (and CLOSING, which shares its cumulative)
        F.col("var_cf"),
        cum_end.alias("var_cum"),
        csm_movement(cum_mid, cum_end).alias("var_csm"),
        lc_movement(cum_mid, cum_end).alias("var_lc"),
        state_of(cum_end).alias("var_state"),
        (init_amt + var_amt).alias("close_cf"),
        csm_balance(cum_end).alias("close_csm"),
        lc_balance(cum_end).alias("close_lc"),
    )


def _row(step: str, cf, cum, csm, lc, state) -> F.Column:
    return F.struct(
        F.lit(step).alias("aoc_step"),
        F.lit(S.AOC_ORDER[step]).alias("aoc_order"),
        money(cf).alias("cf_amount"),
        money(cum).alias("cf_cumulative"),
        money(csm).alias("csm_amount"),
        money(lc).alias("lc_amount"),
        state.cast("string").alias("profitability_state"),
    )


def goc_bs_state(periods: DataFrame) -> DataFrame:
    """Long GoC ledger: OPENING / INIT_RECOG / VARIANCE / CLOSING rows."""
    zero = F.lit(0)
    prev = F.col("prev_cum")
    opening = (
        F.when(F.col("has_rollforward"),
               _row(S.OPENING, prev, prev, csm_balance(prev), lc_balance(prev), state_of(prev)))
        .when(F.col("has_init"), _row(S.OPENING, zero, zero, zero, zero, F.lit(None)))
    )
    init = F.when(F.col("has_init"), _row(
        S.INIT_RECOG, F.col("init_cf"), F.col("init_cum"), F.col("init_csm"), F.col("init_lc"),
        F.col("init_state")))
    var = F.when(F.col("has_var"), _row(
        S.VARIANCE, F.col("var_cf"), F.col("var_cum"), F.col("var_csm"), F.col("var_lc"),
        F.col("var_state")))
    closing = F.when(F.col("has_var"), _row(
        S.CLOSING, F.col("close_cf"), F.col("var_cum"), F.col("close_csm"), F.col("close_lc"),
        F.col("var_state")))
    steps = F.filter(F.array(opening, init, var, closing), lambda s: s.isNotNull())
    return (
        periods.select("goc_id", "goc_type", "reporting_date", "reporting_quarter",
                       F.explode(steps).alias("s"))
        .select("goc_id", "goc_type", "reporting_date", "reporting_quarter",
                *[F.col(f"s.{f}").alias(f) for f in _STEP_FIELDS])
    )
