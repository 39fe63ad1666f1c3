"""Treaty balance-sheet state (T1-T11): GoC profitability pushed down to
treaties, plus the CSM release by coverage unit.

Scale: treaties grow with the data (one per supplier in the binding), GoCs do
not.  The treaty ledger is therefore computed with **one** shuffle — the
window exchange on ``treaty_id`` — and every GoC value arrives through a
size-checked broadcast of the wide GoC state (one row per GoC x period), which
keeps the treaty partitioning intact.  The per-date CLOSING sums are window
aggregates over (treaty_id, reporting_date), which the treaty_id partitioning
already satisfies, and the output rows are produced by exploding one array of
structs per cashflow row (no union, no second pass, no self-join).  A GoC state
beyond the broadcast bound is met by a salted shuffle *before* the window
exchange, so that all windows still share that one partitioning.

Each cashflow row (INIT_RECOG or VARIANCE of a treaty at a date) emits:

* OPENING — at an INIT_RECOG in quarter 1: zeros, NULL state; at a VARIANCE
  whose treaty had a VARIANCE in the previous quarter (and whose GoC closed that
  quarter): the treaty's own previous cumulative, its CSM/LC by the treaty's own
  sign, the GoC's previous closing state, and a CSM proxy
  ``goc_closing_csm * treaty_cum / goc_cum`` when that GoC state was PROFITABLE;
* the movement row itself — CSM/LC are the GoC step amounts pro rata
  ``amount / goc_step_cf`` (0 when the GoC step nets to 0); the proxy is the
  GoC's VARIANCE *movement* times ``treaty_cum / goc_cum``; state is the GoC's
  post-VARIANCE state.  It needs the GoC's VARIANCE (and, for INIT_RECOG, its
  INIT_RECOG) at the same date;
* CSM_RELEASE — at a VARIANCE in a release quarter that has an OPENING:
  ``|opening proxy| * ratio`` when the GoC is PROFITABLE after the VARIANCE and
  the proxy is negative, else 0;
* CLOSING — once per treaty x date: the sum of all of the above at 6 decimals,
  cast last; proxy and state of the VARIANCE row.

With ``params.carry_release`` the releases reach the next OPENING: its CSM and
proxy are net of what has been released so far, the release is taken from that net
proxy, and a CSM that melts away uses up the releases (see ``_with_kept_release``).

Pro-rata amounts multiply first and divide last, at DECIMAL(38,6), so the
result stays exact whatever the size of the GoC balances.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gocledger import schema as S
from gocledger.functions import (
    aoc_order,
    csm_balance,
    lc_balance,
    money,
    period_index,
    precise,
    pro_rata,
    release_ratio,
)
from gocledger.params import LedgerParams
from gocledger.operators.allocation import to_the_cent
from gocledger.operators.coverage import RATIO, with_ratio
from gocledger.operators.joins import bounded_broadcast_join, fits_broadcast

# GoC values a treaty row needs, from the GoC row of the same date: its own
# INIT_RECOG / VARIANCE step and the previous quarter's CLOSING.
_SNAPSHOT = {
    "has_init": "g_has_init", "has_var": "g_has_var",
    "init_cf": "g_init_cf", "init_csm": "g_init_csm", "init_lc": "g_init_lc",
    "var_cf": "g_var_cf", "var_cum": "g_var_cum", "var_csm": "g_var_csm", "var_lc": "g_var_lc",
    "var_state": "g_var_state",
    "prev_closed": "p_closed", "prev_cum": "p_cum", "prev_csm": "p_csm", "prev_state": "p_state",
}
_MONEY_COLS = {"init_cf", "init_csm", "init_lc", "var_cf", "var_cum", "var_csm", "var_lc", "prev_cum", "prev_csm"}


def _snapshot(goc_periods: DataFrame) -> DataFrame:
    return goc_periods.select(
        "goc_id", "reporting_date",
        *[(money(F.col(src)) if src in _MONEY_COLS else F.col(src)).alias(dst) for src, dst in _SNAPSHOT.items()])


def _out(step: str, proxy, cf, csm, lc, state) -> F.Column:
    return F.struct(
        F.lit(step).alias("aoc_step"),
        F.lit(S.AOC_ORDER[step]).alias("aoc_order"),
        precise(proxy).alias("treaty_csm_proxy"),
        precise(cf).alias("cf_amount"),
        precise(csm).alias("csm_amount"),
        precise(lc).alias("lc_amount"),
        state.cast("string").alias("profitability_state"),
    )


def _net_proxy(proxy: F.Column, kept: F.Column) -> F.Column:
    """An opening proxy less what has been released of it; a proxy that is no CSM stays."""
    return F.when(proxy < 0, F.least(precise(F.lit(0)), precise(proxy + kept))).otherwise(precise(proxy))


def _release(due: F.Column, state: F.Column, proxy: F.Column, ratio: F.Column) -> F.Column:
    return F.when(due & (state == S.PROFITABLE) & (proxy < 0), precise(F.abs(proxy) * ratio)).otherwise(precise(F.lit(0)))


def _with_kept_release(ev: DataFrame, params: LedgerParams) -> DataFrame:
    """``kept``: what has been released of a treaty's CSM before each row and not been used up since.

    A release is a fraction of the CSM that earlier releases left, and what is kept
    never exceeds the gross CSM of the quarter's end, so a CSM that melts away takes
    the releases with it: the state depends on the path, and no running sum gives it.
    Each treaty's rows (a few per quarter of its life) are folded in order; they are
    gathered by the partitioning that the windows have made already."""
    zero = precise(F.lit(0))
    names = [c for c in ev.columns if c != "treaty_id"]
    order = ["reporting_date", "step_order"]
    rows = F.array_sort(F.collect_list(F.struct(*order, *[c for c in names if c not in order])))

    def step(acc: F.Column, r: F.Column) -> F.Column:
        proxy = F.when(r["has_roll"], _net_proxy(r["roll_proxy"], acc["kept"])).otherwise(zero)
        ratio = r["ratio"] if "ratio" in names else release_ratio(r["reporting_quarter"], params.release_ratios)
        rel = F.coalesce(_release(r["has_release"], r["g_var_state"], proxy, ratio), zero)
        end = F.least(precise(acc["kept"] + rel), F.greatest(precise(r["after_cum"]), zero))
        return F.struct(F.when(r["aoc_step"] == S.VARIANCE, end).otherwise(acc["kept"]).alias("kept"),
                        F.concat(acc["before"], F.array(acc["kept"])).alias("before"))

    start = F.struct(zero.alias("kept"), F.array().cast(T.ArrayType(S.PRECISE)).alias("before"))
    folded = ev.groupBy("treaty_id").agg(rows.alias("rows")).select(
        "treaty_id", "rows", F.aggregate("rows", start, step, lambda acc: acc["before"]).alias("before"))
    each = folded.select("treaty_id", F.explode(F.arrays_zip("rows", "before")).alias("x"))
    return each.select("treaty_id", *[F.col(f"x.rows.{c}").alias(c) for c in names if c not in ("after_cum", "step_order")],
                       F.col("x.before").alias("kept"))


def _handed_out(ev: DataFrame) -> DataFrame:
    """Movement amounts in whole cents that add up to the GoC's step."""
    shares = {}
    for c in ("csm", "lc"):
        shares[f"share_{c}"] = f"goc_{c}"
        ev = ev.withColumn(f"share_{c}", F.when(F.col("has_move"), F.col(f"move_{c}")))
    ev = to_the_cent(ev, shares, ["goc_id", "reporting_date", "aoc_step"], "treaty_id")
    return ev.withColumns({f"move_{c}": F.coalesce(f"share_{c}", f"move_{c}") for c in ("csm", "lc")}).drop(
        "share_csm", "share_lc", "goc_csm", "goc_lc")


def treaty_bs_state(
    treaty_movement: DataFrame,
    goc_periods: DataFrame,
    goc_period_rows: int,
    params: LedgerParams = LedgerParams(),
    cut: Callable[[DataFrame], DataFrame] = lambda df: df,
    carry_in: DataFrame | None = None,
    patterns: DataFrame | None = None,
    last_year: int = 0,
) -> DataFrame:
    """The ledger of all treaties.  ``cut`` writes rows that are read more than once (only
    the allocation to the cent does).  ``carry_in``: the treaties' balances at the end of the
    quarter before the movements' first one (see :func:`treaty_balances`).  ``patterns``: release
    patterns of single treaties (see :mod:`gocledger.operators.coverage`), ``last_year`` the last
    with movements."""
    if carry_in is not None and params.carry_release:
        raise ValueError("carried releases depend on the whole history: no carry-in")
    step = F.col("aoc_step")
    is_init, is_var = step == S.INIT_RECOG, step == S.VARIANCE
    zero = F.lit(0)
    pidx = period_index(F.col("reporting_date"))

    snapshot = _snapshot(goc_periods)
    ev = treaty_movement.filter(step.isin(*S.INPUT_STEPS)).withColumn("aoc_order", aoc_order(step)).select(
        "treaty_id", "goc_id", "treaty_type", "reporting_date", "reporting_quarter", "aoc_step", "aoc_order", "amount",
        F.when(is_var, pidx).alias("var_period"))
    if patterns is not None:
        ev = with_ratio(ev, patterns, last_year, release_ratio(F.col("reporting_quarter"), params.release_ratios))
    if carry_in is not None:
        # A treaty's past as one row ahead of its movements; it leaves again behind the windows over the past.
        end = F.last_day(F.make_date(F.floor((F.col("period") - 1) / 4).cast("int"), ((F.col("period") - 1) % 4 * 3 + 3).cast("int"), F.lit(1)))
        ev = ev.unionByName(carry_in.select(
            "treaty_id", "goc_id", "treaty_type", end.alias("reporting_date"), F.quarter(end).alias("reporting_quarter"),
            F.lit("CARRIED").alias("aoc_step"), F.lit(0).alias("aoc_order"), "amount", "var_period",
            *([F.lit(None).cast(RATIO).alias("ratio")] if patterns is not None else [])))

    def with_goc(rows: DataFrame) -> DataFrame:
        return bounded_broadcast_join(
            rows, snapshot, ["goc_id", "reporting_date"], "left",
            small_rows=goc_period_rows, max_bytes=params.broadcast_max_bytes,
            salt_buckets=params.salt_buckets, salt_key="treaty_id")

    # -- GoC values of the same date: broadcast beside the windows, or shuffled ahead of them
    late = fits_broadcast(snapshot, goc_period_rows, params.broadcast_max_bytes)
    ev = ev if late else with_goc(ev)

    # -- one exchange on treaty_id: running cumulative, period total, previous VARIANCE quarter
    by_treaty = Window.partitionBy("treaty_id").orderBy("reporting_date", "aoc_order")
    by_date = Window.partitionBy("treaty_id", "reporting_date")
    ev = ev.select(
        "*",
        F.sum("amount").over(by_treaty.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
        F.sum("amount").over(by_date).alias("period_cf"),
        (pidx - F.last("var_period", ignorenulls=True)
         .over(by_treaty.rowsBetween(Window.unboundedPreceding, -1))).alias("var_gap"),
        F.max((is_init & (F.col("reporting_quarter") == 1)).cast("int")).over(by_date).alias("init_q1_at_date"),
    )
    if carry_in is not None:
        ev = ev.filter(step.isin(*S.INPUT_STEPS))
    ev = with_goc(ev) if late else ev

    g_has_var = F.coalesce(F.col("g_has_var"), F.lit(False))
    g_has_init = F.coalesce(F.col("g_has_init"), F.lit(False))
    has_move = g_has_var & (is_var | g_has_init)
    step_cf = F.when(is_init, F.col("g_init_cf")).otherwise(F.col("g_var_cf"))
    step_csm = F.when(is_init, F.col("g_init_csm")).otherwise(F.col("g_var_csm"))
    step_lc = F.when(is_init, F.col("g_init_lc")).otherwise(F.col("g_var_lc"))
    move_proxy = F.when((F.col("g_var_state") == S.PROFITABLE) & (F.col("g_var_cum") != 0),
                        pro_rata(F.col("g_var_csm"), F.col("cum"), F.col("g_var_cum"))).otherwise(zero)
    # previous VARIANCE cumulative = everything before this quarter (VARIANCE closes its quarter)
    prev_var_cum = F.col("cum") - F.col("period_cf")
    has_roll = is_var & (F.col("var_gap") == 1) & F.coalesce(F.col("p_closed"), F.lit(False))
    roll_proxy = F.when((F.col("p_state") == S.PROFITABLE) & (F.col("p_cum") != 0),
                        pro_rata(F.col("p_csm"), prev_var_cum, F.col("p_cum"))).otherwise(zero)
    ev = ev.select(
        "treaty_id", "goc_id", "treaty_type", "reporting_date", "reporting_quarter", "aoc_step", "amount",
        "g_var_state", "init_q1_at_date",
        has_move.alias("has_move"), move_proxy.alias("move_proxy"),
        pro_rata(step_csm, F.col("amount"), step_cf).alias("move_csm"),
        pro_rata(step_lc, F.col("amount"), step_cf).alias("move_lc"),
        F.coalesce(has_roll, F.lit(False)).alias("has_roll"), prev_var_cum.alias("roll_cf"),
        roll_proxy.alias("roll_proxy"), F.col("p_state").alias("roll_state"),
        *([F.col("cum").alias("after_cum"), F.col("aoc_order").alias("step_order")] if params.carry_release else []),
        *(["ratio"] if patterns is not None else []),
        *([money(step_csm).alias("goc_csm"), money(step_lc).alias("goc_lc")] if params.to_the_cent else []),
    )
    if params.to_the_cent:
        ev = _handed_out(cut(ev))

    # -- OPENING choice and CSM release (one OPENING per treaty x date; roll-forward wins)
    roll_at_date = F.max(F.col("has_roll").cast("int")).over(by_date) == 1
    first_at_date = (F.col("init_q1_at_date") == 1) & ~roll_at_date
    ratio = F.col("ratio") if patterns is not None else release_ratio(F.col("reporting_quarter"), params.release_ratios)
    ev = ev.select(
        "*",
        (is_init & first_at_date).alias("has_first"),
        (is_var & F.col("has_move") & ratio.isNotNull() & (F.col("has_roll") | first_at_date)).alias("has_release"),
    )
    if params.carry_release:
        ev = _with_kept_release(ev, params)
        kept = F.col("kept")
        net_proxy = _net_proxy(F.col("roll_proxy"), kept)
    else:
        kept, net_proxy = zero, F.col("roll_proxy")
    open_proxy = F.when(F.col("has_roll"), net_proxy).otherwise(zero)
    ev = ev.select(
        "*",
        open_proxy.alias("open_proxy"),
        _release(F.col("has_release"), F.col("g_var_state"), open_proxy, ratio).alias("rel_csm"),
    )

    # -- CLOSING: per treaty x date sums over the rows above (same partitioning)
    roll_cf = F.when(F.col("has_roll"), F.col("roll_cf")).otherwise(zero)
    roll_csm = F.when(F.col("has_roll"), csm_balance(F.col("roll_cf")) + kept).otherwise(zero)
    roll_lc = F.when(F.col("has_roll"), lc_balance(F.col("roll_cf"))).otherwise(zero)
    mv = F.col("has_move")
    cf_part = roll_cf + F.when(mv, F.col("amount")).otherwise(zero)
    csm_part = roll_csm + F.when(mv, F.col("move_csm")).otherwise(zero) \
        + F.when(F.col("has_release"), F.col("rel_csm")).otherwise(zero)
    lc_part = roll_lc + F.when(mv, F.col("move_lc")).otherwise(zero)
    any_part = (F.col("has_roll") | F.col("has_first") | mv | F.col("has_release")).cast("int")
    var_move = is_var & mv
    ev = ev.select(
        "*",
        F.sum(cf_part).over(by_date).alias("c_cf"),
        F.sum(csm_part).over(by_date).alias("c_csm"),
        F.sum(lc_part).over(by_date).alias("c_lc"),
        F.max(F.when(var_move, F.col("move_proxy"))).over(by_date).alias("c_proxy"),
        F.max(F.when(var_move, F.col("g_var_state"))).over(by_date).alias("c_state"),
        F.max(any_part).over(by_date).alias("c_any"),
        F.max(is_var.cast("int")).over(by_date).alias("c_has_var"),
    )
    emits_closing = (F.col("c_any") == 1) & (is_var | (F.col("c_has_var") == 0))

    null_state = F.lit(None).cast("string")
    rows = F.array(
        F.when(F.col("has_first"), _out(S.OPENING, zero, zero, zero, zero, null_state)),
        F.when(F.col("has_roll"), _out(S.OPENING, F.col("open_proxy"), F.col("roll_cf"),
                                       csm_balance(F.col("roll_cf")) + kept, lc_balance(F.col("roll_cf")),
                                       F.col("roll_state"))),
        F.when(mv, F.struct(
            step.alias("aoc_step"),
            aoc_order(step).alias("aoc_order"),
            precise(F.col("move_proxy")).alias("treaty_csm_proxy"),
            precise(F.col("amount")).alias("cf_amount"),
            precise(F.col("move_csm")).alias("csm_amount"),
            precise(F.col("move_lc")).alias("lc_amount"),
            F.col("g_var_state").alias("profitability_state"),
        )),
        F.when(F.col("has_release"), _out(S.CSM_RELEASE, F.col("open_proxy"), zero, F.col("rel_csm"),
                                          zero, F.col("g_var_state"))),
        F.when(emits_closing, _out(S.CLOSING, F.col("c_proxy"), F.col("c_cf"), F.col("c_csm"),
                                   F.col("c_lc"), F.col("c_state"))),
    )
    out = ev.select(
        "treaty_id", "goc_id", "treaty_type", "reporting_date", "reporting_quarter",
        F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r"),
    )
    return out.select(
        "treaty_id", "goc_id", "treaty_type", "reporting_date", "reporting_quarter",
        F.col("r.aoc_step").alias("aoc_step"),
        F.col("r.aoc_order").alias("aoc_order"),
        money(F.col("r.treaty_csm_proxy")).alias("treaty_csm_proxy"),
        money(F.col("r.cf_amount")).alias("cf_amount"),
        money(F.col("r.csm_amount")).alias("csm_amount"),
        money(F.col("r.lc_amount")).alias("lc_amount"),
        F.col("r.profitability_state").alias("profitability_state"),
    )


def treaty_balances(treaty_movement: DataFrame, last_period: int, carry_in: DataFrame | None = None) -> DataFrame:
    """(treaty_id, goc_id, treaty_type, period, amount, var_period): every treaty's gross cumulative at
    the end of each quarter from its first movement to ``last_period`` (absolute quarters), and
    the quarter of its last VARIANCE till then."""
    pidx = period_index(F.col("reporting_date"))
    ev = treaty_movement.filter(F.col("aoc_step").isin(*S.INPUT_STEPS)).select(
        "treaty_id", "goc_id", "treaty_type", pidx.alias("period"), "amount",
        F.when(F.col("aoc_step") == S.VARIANCE, pidx).alias("var_period"))
    if carry_in is not None:
        ev = ev.unionByName(carry_in.select(ev.columns))
    each = ev.groupBy("treaty_id", "goc_id", "treaty_type", "period").agg(
        F.sum("amount").alias("amount"), F.max("var_period").alias("var_period"))
    by_treaty = Window.partitionBy("treaty_id").orderBy("period")
    past = by_treaty.rowsBetween(Window.unboundedPreceding, 0)
    run = each.select(
        "treaty_id", "goc_id", "treaty_type", "period", money(F.sum("amount").over(past)).alias("amount"),
        F.max("var_period").over(past).alias("var_period"),
        F.coalesce(F.lead("period").over(by_treaty) - 1, F.greatest(F.lit(last_period), F.col("period"))).alias("until"))
    return run.withColumn("period", F.explode(F.sequence("period", "until"))).drop("until")


def treaty_cumulative(treaty_movement: DataFrame) -> DataFrame:
    """T2 on its own: running treaty cashflow cumulative, ordered by (date, step order)."""
    w = Window.partitionBy("treaty_id").orderBy("reporting_date", "aoc_order") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ev = treaty_movement.filter(F.col("aoc_step").isin(*S.INPUT_STEPS)) \
        .withColumn("aoc_order", aoc_order(F.col("aoc_step")))
    return ev.select("treaty_id", "reporting_date", "aoc_step",
                     money(F.sum("amount").over(w)).alias("treaty_cf_cumulative"))
