"""Edge fixtures: each is checked by brute force against the SQL oracle and by
targeted assertions on the rule it exercises."""

import datetime as dt
from decimal import Decimal as D

import pytest

from ledger_helpers import brute_force_mismatches, rows
from gocledger import schema as S
from gocledger.plans.pipeline import Ledger

Q = {1: dt.date(2026, 3, 31), 2: dt.date(2026, 6, 30), 3: dt.date(2026, 9, 30), 4: dt.date(2026, 12, 31)}
Q27 = {1: dt.date(2027, 3, 31), 2: dt.date(2027, 6, 30), 3: dt.date(2027, 9, 30), 4: dt.date(2027, 12, 31)}
INC = dt.date(2026, 1, 1)

CORE = ["int_treaty_quarterly_movement", "int_goc_quarterly_movement", "int_goc_bs_state",
        "int_treaty_bs_state", "int_retro_quarterly_movement", "int_retro_bs_state", "mart_goc_aoc_quarterly",
        "mart_goc_annual_summary", "mart_annual_aoc_detail", "mart_pnl_quarterly", "val_summary"]


def make_ledger(spark, gocs, treaties, cashflows, links=(), **kw):
    raw = {
        "goc_master": spark.createDataFrame(
            [(g, t, st, f"{g} scenario") for g, t, st in gocs], S.GOC_MASTER),
        "treaty_master": spark.createDataFrame(
            [(t, ty, g, inc or INC) for t, ty, g, *rest in treaties for inc in [rest[0] if rest else None]],
            S.TREATY_MASTER),
        "retro_link": spark.createDataFrame(
            [(a, r, D(rate), INC) for a, r, rate in links], S.RETRO_LINK),
        "cashflow_input": spark.createDataFrame(
            [(t, d, step, D(str(a)).quantize(D("0.01"))) for t, d, step, a in cashflows], S.CASHFLOW_INPUT),
        "assumption_version": spark.createDataFrame([("V1", "edge", INC)], S.ASSUMPTION_VERSION),
    }
    return Ledger(spark, raw, **kw)


def cf(treaty, init, variances, dates=Q):
    out = []
    if init is not None:
        out.append((treaty, dates[1] if not isinstance(init, tuple) else dates[init[0]], S.INIT_RECOG,
                    init if not isinstance(init, tuple) else init[1]))
    for q, v in variances.items():
        out.append((treaty, dates[q], S.VARIANCE, v))
    return out


def states(led, goc):
    return [r.profitability_state for r in led.int_goc_bs_state.filter(
        f"goc_id = '{goc}' and aoc_step in ('INIT_RECOG', 'VARIANCE')").orderBy("reporting_date", "aoc_order")
        .collect()]


@pytest.fixture(scope="module")
def break_even(spark):
    return make_ledger(
        spark,
        gocs=[("GOC_E", "ASSUMED", "PROFITABLE"), ("GOC_F", "ASSUMED", "ONEROUS")],
        treaties=[("T_E1", "ASSUMED", "GOC_E"), ("T_F1", "ASSUMED", "GOC_F")],
        cashflows=cf("T_E1", 1000, {1: -1000, 2: 500, 3: -500, 4: -300})
        + cf("T_F1", -1000, {1: 1000, 2: -200, 3: 200, 4: 700}),
    )


def test_break_even_both_sides(break_even):
    assert states(break_even, "GOC_E") == ["PROFITABLE", "BREAK_EVEN", "PROFITABLE", "BREAK_EVEN", "ONEROUS"]
    assert states(break_even, "GOC_F") == ["ONEROUS", "BREAK_EVEN", "ONEROUS", "BREAK_EVEN", "PROFITABLE"]
    e = rows(break_even.int_goc_bs_state.filter("goc_id = 'GOC_E' and aoc_step = 'VARIANCE'"),
             "reporting_quarter", "csm_amount", "lc_amount")
    # P->BE releases the CSM, BE->P builds CSM, P->BE again, BE->O goes to LC
    assert e == [(1, D("1000.00"), D("0.00")), (2, D("-500.00"), D("0.00")), (3, D("500.00"), D("0.00")),
                 (4, D("0.00"), D("-300.00"))]
    f = rows(break_even.int_goc_bs_state.filter("goc_id = 'GOC_F' and aoc_step = 'VARIANCE'"),
             "reporting_quarter", "csm_amount", "lc_amount")
    assert f == [(1, D("0.00"), D("1000.00")), (2, D("0.00"), D("-200.00")), (3, D("0.00"), D("200.00")),
                 (4, D("-700.00"), D("0.00"))]


def test_break_even_oracle_and_validators(spark, break_even):
    assert brute_force_mismatches(spark, break_even, CORE) == {}
    assert {r.validation: r.fail_count for r in break_even.val_summary.collect()}["val_bs_invariants"] == 0


@pytest.fixture(scope="module")
def mixed(spark):
    return make_ledger(
        spark,
        gocs=[("GOC_M", "ASSUMED", "PROFITABLE"), ("GOC_MR", "RETRO", "PROFITABLE")],
        treaties=[("T_M1", "ASSUMED", "GOC_M"), ("T_M2", "ASSUMED", "GOC_M"), ("T_M3", "ASSUMED", "GOC_M"),
                  ("T_MR", "RETRO", "GOC_MR")],
        cashflows=cf("T_M1", 5000, {1: -2000, 2: 100, 3: -7000, 4: 10})
        + cf("T_M2", -3000, {1: 2000, 2: 200, 3: 1000, 4: 20})
        + cf("T_M3", 1000.05, {1: 0, 2: -300, 3: 333.33, 4: -30}),
        links=[("T_M1", "T_MR", "0.35"), ("T_M2", "T_MR", "0.35"), ("T_M3", "T_MR", "0.10")],
    )


def test_mixed_signs_and_net_zero(spark, mixed):
    assert brute_force_mismatches(spark, mixed, CORE) == {}
    # Q1 variances net to 0 at GoC level: nothing is allocated to any treaty
    q1 = rows(mixed.int_treaty_bs_state.filter("aoc_step = 'VARIANCE' and reporting_quarter = 1"),
              "treaty_id", "csm_amount", "lc_amount")
    assert q1 == [("T_M1", D("0.00"), D("0.00")), ("T_M2", D("0.00"), D("0.00")), ("T_M3", D("0.00"), D("0.00"))]
    # opposite-sign treaties get opposite-sign shares of the GoC movement
    q3 = {r.treaty_id: r.csm_amount + r.lc_amount for r in
          mixed.int_treaty_bs_state.filter("aoc_step = 'VARIANCE' and reporting_quarter = 3").collect()}
    assert (q3["T_M1"] < 0) != (q3["T_M2"] < 0)


def test_missing_init_and_orphans(spark):
    led = make_ledger(
        spark,
        gocs=[("GOC_A", "ASSUMED", "PROFITABLE"), ("GOC_N", "ASSUMED", "ONEROUS")],
        treaties=[("T_A", "ASSUMED", "GOC_A"), ("T_N", "ASSUMED", "GOC_N")],
        cashflows=cf("T_A", 100, {1: -10, 2: -10}) + cf("T_N", None, {1: -50, 2: -50})
        + cf("T_ORPHAN", 70, {1: 1}),
    )
    assert brute_force_mismatches(spark, led, CORE) == {}
    assert led.int_goc_bs_state.filter("goc_id = 'GOC_N'").count() == 0        # no INIT_RECOG -> no state
    assert led.int_treaty_quarterly_movement.filter("treaty_id = 'T_ORPHAN'").count() == 0
    assert led.int_treaty_bs_state.filter("treaty_id = 'T_N' and aoc_step != 'OPENING'").count() == 0


def test_gap_quarters(spark):
    led = make_ledger(
        spark,
        gocs=[("GOC_G", "ASSUMED", "PROFITABLE"), ("GOC_H", "ASSUMED", "PROFITABLE")],
        treaties=[("T_G1", "ASSUMED", "GOC_G"), ("T_G2", "ASSUMED", "GOC_G"), ("T_H1", "ASSUMED", "GOC_H")],
        cashflows=cf("T_G1", 1000, {1: -100, 3: -100, 4: -100}) + cf("T_G2", 500, {1: -50, 2: -50, 3: -50, 4: -50})
        + cf("T_H1", 800, {1: -10, 2: -10, 4: -10}),
    )
    assert brute_force_mismatches(spark, led, CORE) == {}
    # treaty gap: T_G1 has no Q2 row, so no OPENING in Q2 (no row) nor in Q3 (chain broken)
    g1_open = rows(led.int_treaty_bs_state.filter("treaty_id = 'T_G1' and aoc_step = 'OPENING'"),
                   "reporting_quarter")
    assert g1_open == [(1,), (4,)]
    # GoC gap: GOC_H has no Q3, so its Q4 has no OPENING
    h_open = rows(led.int_goc_bs_state.filter("goc_id = 'GOC_H' and aoc_step = 'OPENING'"), "reporting_quarter")
    assert h_open == [(1,), (2,)]


def test_late_inception_and_two_years(spark):
    dates = {**Q, **{q + 4: d for q, d in Q27.items()}}
    led = make_ledger(
        spark,
        gocs=[("GOC_Y", "ASSUMED", "PROFITABLE"), ("GOC_L", "ASSUMED", "PROFITABLE")],
        treaties=[("T_Y", "ASSUMED", "GOC_Y"), ("T_L1", "ASSUMED", "GOC_L", dt.date(2026, 4, 1)),
                  ("T_L2", "ASSUMED", "GOC_L")],
        cashflows=cf("T_Y", 1000, {q: -50 for q in range(1, 9)}, dates)
        + cf("T_L1", (2, 400), {2: -20, 3: -20, 4: -20})
        + cf("T_L2", 600, {1: -30, 2: -30, 3: -30, 4: -30}),
    )
    assert brute_force_mismatches(spark, led, CORE) == {}
    # the roll-forward crosses the year end: 2027-Q1 opens at the 2026-Q4 closing
    y = {(r.reporting_date, r.aoc_step): r for r in led.int_goc_bs_state.filter("goc_id = 'GOC_Y'").collect()}
    assert y[(Q27[1], "OPENING")].cf_cumulative == y[(Q[4], "CLOSING")].cf_cumulative == D("800.00")
    assert y[(Q27[4], "CLOSING")].cf_cumulative == D("600.00")
    # a second INIT_RECOG in Q2 adds to the running cumulative from its own quarter on
    l_init = led.int_goc_bs_state.filter("goc_id = 'GOC_L' and aoc_step = 'INIT_RECOG'").count()
    assert l_init == 2


def test_release_half_cent_ties(spark):
    led = make_ledger(
        spark,
        gocs=[("GOC_T", "ASSUMED", "PROFITABLE")],
        treaties=[("T_T", "ASSUMED", "GOC_T")],
        cashflows=cf("T_T", 1000.10, {1: 0, 2: 0, 3: 0.20, 4: 0}),
    )
    assert brute_force_mismatches(spark, led, CORE) == {}
    rel = rows(led.int_treaty_bs_state.filter("aoc_step = 'CSM_RELEASE'"), "reporting_quarter", "csm_amount")
    # 1000.10 * 0.55 = 550.055 -> 550.06 ; 1000.30 * 0.45 = 450.135 -> 450.14 (half up)
    assert rel == [(2, D("550.06")), (4, D("450.14"))]


def test_retro_links_many_and_none(spark):
    led = make_ledger(
        spark,
        gocs=[("GOC_O", "ASSUMED", "ONEROUS"), ("GOC_R", "RETRO", "PROFITABLE")],
        treaties=[("T_O1", "ASSUMED", "GOC_O"), ("T_O2", "ASSUMED", "GOC_O"), ("T_RA", "RETRO", "GOC_R"),
                  ("T_RB", "RETRO", "GOC_R")],
        cashflows=cf("T_O1", -1000, {1: -100, 2: -100}) + cf("T_O2", -500, {1: -50, 2: 10}),
        links=[("T_O1", "T_RA", "0.30"), ("T_O1", "T_RB", "0.20")],
    )
    assert brute_force_mismatches(spark, led, CORE + ["val_retro_no_double_recovery"]) == {}
    rm = led.int_retro_quarterly_movement
    assert rm.filter("assumed_treaty_id = 'T_O2'").count() == 0
    assert rows(rm.filter("aoc_step = 'INIT_RECOG'"), "retro_treaty_id", "lrc_amount") == [
        ("T_RA", D("300.0000")), ("T_RB", D("200.0000"))]


def test_salted_fallback_equals_broadcast(spark, mixed):
    from gocledger.params import LedgerParams
    salted = Ledger(spark, mixed.raw, params=LedgerParams(broadcast_max_bytes=0))
    for name in ("int_treaty_bs_state", "int_retro_quarterly_movement"):
        cols = salted.model(name).columns
        assert sorted(map(tuple, salted.model(name).collect())) == \
            sorted(map(tuple, mixed.model(name).select(*cols).collect())), name
    assert "pmod(hash(treaty_id" in salted.int_treaty_bs_state._jdf.queryExecution().executedPlan().toString()


def test_skewed_goc_salted_with_default_buckets(spark):
    """One GoC holds nearly all treaties; the salted join gives what the broadcast gives."""
    from gocledger.params import LedgerParams
    treaties = [(f"T_H{i}", "ASSUMED", "GOC_H") for i in range(60)] + [("T_S", "ASSUMED", "GOC_S")]
    flows = [x for i, (t, _, _) in enumerate(treaties) for x in cf(t, 100 + i, {1: -50, 2: -70 + i, 3: 10, 4: -5})]
    led = make_ledger(spark, [("GOC_H", "ASSUMED", "PROFITABLE"), ("GOC_S", "ASSUMED", "ONEROUS")], treaties, flows)
    salted = Ledger(spark, led.raw, params=LedgerParams(broadcast_max_bytes=0))
    cols = led.int_treaty_bs_state.columns
    assert sorted(map(str, salted.int_treaty_bs_state.select(*cols).collect())) == \
        sorted(map(str, led.int_treaty_bs_state.collect()))
    assert "BroadcastHashJoin" in led.int_treaty_bs_state._jdf.queryExecution().executedPlan().toString()


def test_annual_marts_keep_years_apart(spark):
    flows = cf("T_Y", 1000, {1: -100, 2: -100, 3: -100, 4: -100}) + cf("T_Y", None, {1: 50, 2: 50, 3: 50, 4: 50}, Q27)
    led = make_ledger(spark, [("GOC_Y", "ASSUMED", "PROFITABLE")], [("T_Y", "ASSUMED", "GOC_Y")], flows)
    got = {r.reporting_year: r for r in led.mart_goc_annual_summary.collect()}
    assert sorted(got) == [2026, 2027]
    assert (got[2026].opening_csm, got[2026].closing_csm, got[2026].init_recog_csm) == (D("0.00"), D("-600.00"), D("-1000.00"))
    assert (got[2027].opening_csm, got[2027].closing_csm, got[2027].init_recog_csm) == (D("-600.00"), D("-800.00"), D("0.00"))
    assert (got[2026].total_variance_csm, got[2027].total_variance_csm) == (D("400.00"), D("-200.00"))
    detail = {(r.reporting_year, r.aoc_step): r.annual_csm_amount for r in led.mart_annual_aoc_detail.collect()}
    assert detail[(2026, "VARIANCE")] == D("400.00") and detail[(2027, "VARIANCE")] == D("-200.00")


def test_marts_in_published_order(spark, mixed):
    from gocledger import schema as S
    from gocledger.operators import marts
    order = S.AOC_ORDER
    goc = mixed.mart_goc_aoc_quarterly
    q = marts.mart_goc_aoc_quarterly(mixed.int_goc_bs_state, mixed.int_treaty_bs_state, mixed.int_retro_bs_state,
                                     mixed.stg_goc_master, ordered=True).collect()
    assert [(r.goc_id, r.reporting_date, r.aoc_order) for r in q] == sorted((r.goc_id, r.reporting_date, r.aoc_order) for r in q)
    t = marts.mart_treaty_aoc_quarterly(mixed.int_treaty_bs_state, mixed.stg_treaty_master, ordered=True).collect()
    assert [(r.treaty_id, r.reporting_date, order[r.aoc_step]) for r in t] == \
        sorted((r.treaty_id, r.reporting_date, order[r.aoc_step]) for r in t)
    a = marts.mart_goc_annual_summary(goc, ordered=True).collect()
    assert [(r.goc_id, r.reporting_year) for r in a] == sorted((r.goc_id, r.reporting_year) for r in a)
    d = marts.mart_annual_aoc_detail(goc, ordered=True).collect()
    assert [(r.goc_id, r.reporting_year, order[r.aoc_step]) for r in d] == \
        sorted((r.goc_id, r.reporting_year, order[r.aoc_step]) for r in d)
    p = marts.mart_pnl_quarterly(mixed.int_goc_bs_state, mixed.int_treaty_bs_state, mixed.int_retro_bs_state,
                                 ordered=True).collect()
    assert [r.reporting_date for r in p] == sorted(r.reporting_date for r in p)
