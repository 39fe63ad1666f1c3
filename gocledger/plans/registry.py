"""Registered queries: name -> (spark, sf_dir) -> DataFrame over the driver tables.

Every query binds the driver tables (``lineitem`` is the large one) and runs the
model it names over them in full; the SQL oracle for the same names lives in
:mod:`gocledger.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gocledger import schema as S
from gocledger.functions import money, state_of
from gocledger.operators import quality, treaty_state, validate
from gocledger.params import LedgerParams
from gocledger.plans.pipeline import Ledger
from gocledger.sources import binding

Query = Callable[[SparkSession, str], DataFrame]


# Models whose plan reads the treaty ledger in several branches (release
# roll-up and retro recovery, or several validators).  Column pruning gives each
# branch its own projection of the ledger, so Spark cannot reuse one exchange
# and would shuffle the treaty rows once per branch; writing the ledger once
# keeps that to a single shuffle at any scale.
MULTI_READ_TREATY = frozenset({
    "mart_goc_aoc_quarterly", "mart_goc_annual_summary", "mart_annual_aoc_detail", "mart_pnl_quarterly",
    "val_summary",
})


# Models that need only the GoC state: the treaty movements are read once by it,
# so they are not written out first (see ``Ledger.share_movements``).
GOC_ONLY = frozenset({
    "int_goc_bs_state", "val_bs_invariants", "val_profitability_consistency", "val_rollforward_continuity",
    "val_scenario_expectation",
})


# Models that read the retro movements in several branches (V4 and V7 of the
# summary): the losses x links join is written once instead of run per branch.
MULTI_READ_RETRO = frozenset({"val_summary"})


def _ledger(spark: SparkSession, sf_dir: str, materialize_treaty: bool = False, goc_only: bool = False,
            materialize_retro: bool = False) -> Ledger:
    return Ledger.from_driver(spark, sf_dir, materialize_treaty=materialize_treaty, share_movements=not goc_only,
                              materialize_retro=materialize_retro)


def _goc_ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    return _ledger(spark, sf_dir, goc_only=True)


def _model(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _ledger(spark, sf_dir, materialize_treaty=name in MULTI_READ_TREATY,
                       goc_only=name in GOC_ONLY, materialize_retro=name in MULTI_READ_RETRO).model(name)
    q.__name__ = name
    return q


def _step_filter(model: str, *steps: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        led = _ledger(spark, sf_dir, goc_only=model in GOC_ONLY)
        return led.model(model).filter(F.col("aoc_step").isin(*steps))
    return q


def _src(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _ledger(spark, sf_dir).source(name)
    return q


def aoc_order_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = _ledger(spark, sf_dir).int_treaty_bs_state
    return ts.groupBy("aoc_step", "aoc_order").agg(F.count(F.lit(1)).alias("n_rows"))


def goc_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _goc_ledger(spark, sf_dir).goc_periods.filter(F.col("has_var"))
    return p.select("goc_id", "reporting_date",
                    money(F.col("var_cum")).alias("cumulative_after"),
                    money(F.col("var_cum") - F.col("var_cf")).alias("cumulative_before"))


def goc_state_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _goc_ledger(spark, sf_dir).goc_periods.filter(F.col("has_var"))
    return p.select("goc_id", "reporting_date",
                    state_of(F.col("var_cum") - F.col("var_cf")).alias("prev_state"),
                    F.col("var_state").alias("profitability_state"),
                    money(F.col("var_csm")).alias("csm_amount"),
                    money(F.col("var_lc")).alias("lc_amount"))


def _goc_variance_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _goc_ledger(spark, sf_dir).goc_periods.filter(F.col("has_var"))


def goc_cumulative_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative including the quarter's VARIANCE."""
    return _goc_variance_periods(spark, sf_dir).select(
        "goc_id", "reporting_date", money(F.col("var_cum")).alias("cumulative_after"))


def goc_cumulative_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative just before the quarter's VARIANCE."""
    return _goc_variance_periods(spark, sf_dir).select(
        "goc_id", "reporting_date", money(F.col("var_cum") - F.col("var_cf")).alias("cumulative_before"))


def goc_state_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State before and after each VARIANCE."""
    return _goc_variance_periods(spark, sf_dir).select(
        "goc_id", "reporting_date", state_of(F.col("var_cum") - F.col("var_cf")).alias("prev_state"),
        F.col("var_state").alias("profitability_state"))


def goc_csm_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSM movement of each VARIANCE transition."""
    return _goc_variance_periods(spark, sf_dir).select(
        "goc_id", "reporting_date", state_of(F.col("var_cum") - F.col("var_cf")).alias("prev_state"),
        F.col("var_state").alias("profitability_state"), money(F.col("var_csm")).alias("csm_amount"))


def goc_lc_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LC movement of each VARIANCE transition."""
    return _goc_variance_periods(spark, sf_dir).select(
        "goc_id", "reporting_date", state_of(F.col("var_cum") - F.col("var_cf")).alias("prev_state"),
        F.col("var_state").alias("profitability_state"), money(F.col("var_lc")).alias("lc_amount"))


def _goc_snapshot(step: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The GoC values the treaty push-down reads."""
        g = _goc_ledger(spark, sf_dir).int_goc_bs_state.filter(F.col("aoc_step") == step)
        return g.select("goc_id", "reporting_date", "reporting_quarter",
                        F.col("cf_cumulative").alias("goc_cf_cumulative"), F.col("csm_amount").alias("goc_csm"),
                        "profitability_state")
    return q


def treaty_csm_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The treaty CSM proxy of every ledger row."""
    return _ledger(spark, sf_dir).int_treaty_bs_state.select(
        "treaty_id", "reporting_date", "aoc_step", "treaty_csm_proxy")


def int_treaty_bs_state_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The treaty ledger with releases carried into the next OPENING."""
    return Ledger.from_driver(spark, sf_dir, params=LedgerParams(carry_release=True)).int_treaty_bs_state


def _cent_ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    return Ledger.from_driver(spark, sf_dir, params=LedgerParams(to_the_cent=True))


def int_treaty_bs_state_cent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The treaty ledger with movements allocated to the cent."""
    return _cent_ledger(spark, sf_dir).int_treaty_bs_state


def val_treaty_goc_reconciliation_cent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 on the ledger allocated to the cent, without any tolerance: what is left are OPENINGs of GoCs whose
    treaties have both signs; movements agree exactly."""
    led = _cent_ledger(spark, sf_dir)
    exact = LedgerParams(tolerance=Decimal(0))
    return validate.val_treaty_goc_reconciliation(led.int_treaty_bs_state, led.int_goc_bs_state, exact)


def _patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release patterns for two thirds of the treaties: quarterly and later once a year, or halves from 1998 on."""
    n = F.substring("treaty_id", 6, 18).cast("long") % 3
    t = Ledger.from_driver(spark, sf_dir).stg_treaty_master.where("treaty_type = 'ASSUMED'")

    def pattern(kind: int, since: str, ratios: dict[int, str]) -> DataFrame:
        each = F.explode(F.array(*[F.struct(F.lit(q).alias("quarter"), F.lit(Decimal(r)).cast("decimal(9,6)").alias("ratio"))
                                   for q, r in ratios.items()]))
        return t.where(n == kind).select("treaty_id", F.lit(since).cast("date").alias("effective_date"), each.alias("x")).select(
            "treaty_id", "effective_date", "x.quarter", "x.ratio")

    return (pattern(0, "1997-01-01", dict.fromkeys((1, 2, 3, 4), "0.25")).unionByName(pattern(0, "1999-07-01", {4: "1.00"}))
            .unionByName(pattern(1, "1998-01-01", {2: "0.50", 4: "0.50"})))


def int_treaty_bs_state_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The treaty ledger with release patterns of single treaties."""
    return Ledger.from_driver(spark, sf_dir, patterns=_patterns(spark, sf_dir)).int_treaty_bs_state


def treaty_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treaty_state.treaty_cumulative(_ledger(spark, sf_dir).int_treaty_quarterly_movement)


def dq_test_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 114 declared checks: every model is written once, then read once by the suite."""
    led = Ledger.from_driver(spark, sf_dir, materialize_raw=True)
    led.materialize_all()
    return led.data_tests()


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null(_goc_ledger(spark, sf_dir).int_goc_bs_state, "profitability_state")


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(_ledger(spark, sf_dir).stg_treaty_master, "goc_id")


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_values(_ledger(spark, sf_dir).int_treaty_bs_state, "profitability_state",
                                   [S.PROFITABLE])


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = _goc_ledger(spark, sf_dir)
    return quality.relationships(L.stg_treaty_master, "goc_id", L.int_goc_bs_state, "goc_id")


def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique_combination(_ledger(spark, sf_dir).int_treaty_quarterly_movement,
                                      ["goc_id", "reporting_date", "aoc_step"])


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for t in ("goc_master", "treaty_master", "retro_link", "cashflow_input"):
        q[f"src_{t}"] = _src(t)
    q["raw_row_counts"] = _model("raw_row_counts")
    for name in Ledger.MODELS:
        q[name] = _model(name)
    q["goc_csm_release"] = _model("goc_csm_release")
    q["aoc_order"] = aoc_order_usage
    q["goc_init_recog"] = _step_filter("int_goc_bs_state", S.INIT_RECOG)
    q["goc_variance"] = _step_filter("int_goc_bs_state", S.VARIANCE)
    q["goc_cumulative"] = goc_cumulative
    q["goc_state_transition"] = goc_state_transition
    q["goc_opening"] = _step_filter("int_goc_bs_state", S.OPENING)
    q["goc_closing"] = _step_filter("int_goc_bs_state", S.CLOSING)
    q["goc_cumulative_after"] = goc_cumulative_after
    q["goc_cumulative_before"] = goc_cumulative_before
    q["goc_state_classification"] = goc_state_classification
    q["goc_csm_allocation"] = goc_csm_allocation
    q["goc_lc_allocation"] = goc_lc_allocation
    q["goc_at_variance"] = _goc_snapshot(S.VARIANCE)
    q["goc_at_closing"] = _goc_snapshot(S.CLOSING)
    q["treaty_csm_proxy"] = treaty_csm_proxy
    q["treaty_cumulative"] = treaty_cumulative
    q["int_treaty_bs_state_patterns"] = int_treaty_bs_state_patterns
    q["src_cashflow_input_as_of"] = src_cashflow_input_as_of
    q["int_treaty_bs_state_as_of"] = int_treaty_bs_state_as_of
    q["int_treaty_bs_state_carried"] = int_treaty_bs_state_carried
    q["int_treaty_bs_state_cent"] = int_treaty_bs_state_cent
    q["val_treaty_goc_reconciliation_cent"] = val_treaty_goc_reconciliation_cent
    q["treaty_opening"] = _step_filter("int_treaty_bs_state", S.OPENING)
    q["treaty_movement_allocation"] = _step_filter("int_treaty_bs_state", S.INIT_RECOG, S.VARIANCE)
    q["csm_release"] = _step_filter("int_treaty_bs_state", S.CSM_RELEASE)
    q["treaty_closing"] = _step_filter("int_treaty_bs_state", S.CLOSING)
    q["verify_goc_cashflow"] = _model("verify_goc_cashflow")
    q["verify_cumulative_state"] = _model("verify_cumulative_state")
    q["dq_test_summary"] = dq_test_summary
    q["dq_not_null"] = dq_not_null
    q["dq_unique"] = dq_unique
    q["dq_accepted_values"] = dq_accepted_values
    q["dq_relationships"] = dq_relationships
    q["dq_unique_combination"] = dq_unique_combination
    q.update(FAULTED)
    return q


# ---------------------------------------------------------------------------
# Validators on deliberately corrupted ledgers.  On clean data the validators
# return no rows, so a match with the oracle would prove little; each key
# below shifts amounts on a data-defined set of rows and runs the unchanged
# validator, so both sides must flag exactly the same rows.
# ---------------------------------------------------------------------------
def _shift(df: DataFrame, col: str, cond, delta: str) -> DataFrame:
    return df.withColumn(col, F.when(cond, money(F.col(col) + F.lit(Decimal(delta)))).otherwise(F.col(col)))


def _faulted_goc(led: Ledger) -> DataFrame:
    g = led.int_goc_bs_state
    return _shift(g, "csm_amount", (F.col("aoc_step") == S.CLOSING) & (F.col("cf_cumulative") < 0), "-1.00")


def _shifted_openings(goc_state: DataFrame) -> DataFrame:
    return _shift(goc_state, "lc_amount", (F.col("aoc_step") == S.OPENING) & (F.col("cf_cumulative") < 0), "-0.50")


def _shifted_releases(treaty_state: DataFrame) -> DataFrame:
    return _shift(treaty_state, "cf_amount",
                  (F.col("aoc_step") == S.CSM_RELEASE) & (F.col("profitability_state") == S.ONEROUS), "1.00")


def val_bs_invariants_faulted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.val_bs_invariants(_faulted_goc(_goc_ledger(spark, sf_dir)))


def val_profitability_consistency_faulted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.val_profitability_consistency(_faulted_goc(_goc_ledger(spark, sf_dir)))


def val_rollforward_continuity_faulted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.val_rollforward_continuity(_shifted_openings(_goc_ledger(spark, sf_dir).int_goc_bs_state))


def val_retro_recovery_identity_faulted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rm = _ledger(spark, sf_dir).int_retro_quarterly_movement
    rm = rm.withColumn("lrc_amount", F.when(F.col("aoc_step") == S.INIT_RECOG,
                                            (F.col("lrc_amount") + F.lit(Decimal("0.05"))).cast("decimal(24,4)"))
                       .otherwise(F.col("lrc_amount")))
    return validate.val_retro_recovery_identity(rm)


def val_release_timing_faulted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.val_release_timing(_shifted_releases(_ledger(spark, sf_dir).int_treaty_bs_state))


def val_retro_no_double_recovery_faulted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rm = _ledger(spark, sf_dir).int_retro_quarterly_movement
    rm = rm.withColumn("lrc_amount", F.when(F.col("aoc_step") == S.VARIANCE,
                                            (F.col("lrc_amount") * 2).cast("decimal(24,4)"))
                       .otherwise(F.col("lrc_amount")))
    return validate.val_retro_no_double_recovery(rm)


def _faulted_masters(led: Ledger) -> dict[str, DataFrame]:
    """Staging tables with data-defined faults: repeated, null, unknown and orphan keys and bad values."""
    n = F.substring("treaty_id", 6, 18).cast("long")
    t = led.stg_treaty_master
    treaty = t.withColumns({
        "treaty_type": F.when(n % 4 == 1, "OTHER").when(n % 4 == 2, "UNKNOWN").otherwise(F.col("treaty_type")),
        "goc_id": F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, "GOC_MISSING").otherwise(F.col("goc_id")),
    })
    c = led.stg_cashflow_input
    cash = c.withColumns({
        "treaty_id": F.when(n % 3 == 0, "TRT_GONE").otherwise(F.col("treaty_id")),
        "amount": F.when(n % 4 == 0, F.lit(None)).otherwise(F.col("amount")).cast(S.MONEY),
    })
    return {"stg_goc_master": led.stg_goc_master, "stg_treaty_master": treaty.unionByName(treaty.filter(n % 6 == 0)),
            "stg_retro_link": led.stg_retro_link, "stg_cashflow_input": cash}


def dq_test_summary_faulted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared checks of the staging tables, through the suite, on faulted tables: D1-D5 all fire."""
    led = Ledger.from_driver(spark, sf_dir, materialize_raw=True)
    return quality.run_suite(_faulted_masters(led), staging_tests())


#: The version at which the deliveries of the driver data are looked at.
DELIVERY = "V4"


def _delivered(spark: SparkSession, sf_dir: str) -> Ledger:
    raw = dict(Ledger.from_driver(spark, sf_dir).raw) | {
        "cashflow_input": binding.cashflow_deliveries(spark, sf_dir), "assumption_version": binding.delivery_versions(spark, sf_dir)}
    return Ledger.from_deliveries(spark, raw, version=DELIVERY)


def src_cashflow_input_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cashflows as of a version of their deliveries."""
    return _delivered(spark, sf_dir).source("cashflow_input")


def int_treaty_bs_state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The treaty ledger as of the same version."""
    return _delivered(spark, sf_dir).int_treaty_bs_state


def _gapped(spark: SparkSession, sf_dir: str) -> Ledger:
    """A ledger whose inputs lack treaties, GoCs and INIT_RECOGs, and which keeps what it leaves out."""
    raw = dict(Ledger.from_driver(spark, sf_dir).raw)
    treaty, goc, cash = raw["treaty_master"], raw["goc_master"], raw["cashflow_input"]
    number = lambda c: F.regexp_extract(c, r"(\d+)$", 1).cast("long")
    late = treaty.where(number("goc_id") % 5 == 2).select("treaty_id", F.lit(True).alias("late"))
    cash = cash.join(late, "treaty_id", "left").where(F.col("late").isNull() | (F.col("aoc_step") != S.INIT_RECOG)).drop("late")
    raw |= {"treaty_master": treaty.where(number("treaty_id") % 7 != 3), "goc_master": goc.where(number("goc_id") % 6 != 1),
            "cashflow_input": cash}
    return Ledger(spark, raw, keep_rejects=True)


def rejects_gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a ledger over inputs with gaps leaves out, and why."""
    return _gapped(spark, sf_dir).rejects


def int_goc_bs_state_gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The GoC ledger over the same inputs: rows left out change nothing else."""
    return _gapped(spark, sf_dir).int_goc_bs_state


def staging_tests() -> list[quality.DataTest]:
    return [t for t in quality.declared_tests() if t.model.startswith("stg_")]


def model_tests() -> list[quality.DataTest]:
    return [t for t in quality.declared_tests() if t.model.startswith(("int_", "val_", "mart_"))]


#: What a model's faults depend on: the last digit of a key (for the P&L, of the year).
FAULT_DIGIT = {"int_treaty_quarterly_movement": "treaty_id", "int_treaty_bs_state": "treaty_id",
               "int_retro_quarterly_movement": "assumed_treaty_id", "int_retro_bs_state": "retro_goc_id",
               "val_release_timing": "treaty_id", "mart_treaty_aoc_quarterly": "treaty_id",
               "mart_pnl_quarterly": "CAST(year(reporting_date) AS STRING)"}


def fault_rules(model: str) -> tuple[str, dict[str, str]]:
    """(digit, column -> SQL of its faulted value): the tested columns are null or hold a bad value
    where the digit says so.  Rows of digits 8 and 9 stand twice besides."""
    digit = f"right({FAULT_DIGIT.get(model, 'goc_id')}, 1)"
    columns: dict[str, list[str]] = {}
    nulls = 0
    for t in model_tests():
        if t.model == model and t.test == "not_null":
            columns.setdefault(t.columns[0], []).append(f"WHEN {digit} = '{nulls % 5}' THEN NULL")
            nulls += 1
        elif t.model == model and t.test == "accepted_values":
            bad = f"concat('BAD_', {digit})" if isinstance(t.values[0], str) else f"70 + CAST({digit} AS INT)"
            columns.setdefault(t.columns[0], []).append(f"WHEN {digit} IN ('5', '7') THEN {bad}")
    return digit, {c: f"CASE {' '.join(whens)} ELSE {c} END" for c, whens in columns.items()}


def dq_test_summary_faulted_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared checks of the int, val and mart tables, through the suite, on faulted tables."""
    led = Ledger.from_driver(spark, sf_dir)
    led.materialize_all()
    on_faults = {
        "val_bs_invariants": lambda: validate.val_bs_invariants(_faulted_goc(led)),
        "val_profitability_consistency": lambda: validate.val_profitability_consistency(_faulted_goc(led)),
        "val_rollforward_continuity": lambda: validate.val_rollforward_continuity(_shifted_openings(led.int_goc_bs_state)),
        "val_release_timing": lambda: validate.val_release_timing(_shifted_releases(led.int_treaty_bs_state)),
    }
    models = {}
    for name in {t.model for t in model_tests()}:
        digit, faults = fault_rules(name)
        df = on_faults[name]() if name in on_faults else led.model(name)
        again = F.explode(F.sequence(F.lit(1), F.when(F.expr(f"{digit} IN ('8', '9')"), 2).otherwise(1)))
        models[name] = df.withColumn("_again", again).selectExpr(
            *[f"{faults[c]} AS {c}" if c in faults else c for c in df.columns])
    return quality.run_suite(models, model_tests())


FAULTED = {
    "dq_test_summary_faulted": dq_test_summary_faulted,
    "dq_test_summary_faulted_models": dq_test_summary_faulted_models,
    "rejects_gapped": rejects_gapped,
    "int_goc_bs_state_gapped": int_goc_bs_state_gapped,
    "val_bs_invariants_faulted": val_bs_invariants_faulted,
    "val_profitability_consistency_faulted": val_profitability_consistency_faulted,
    "val_rollforward_continuity_faulted": val_rollforward_continuity_faulted,
    "val_retro_recovery_identity_faulted": val_retro_recovery_identity_faulted,
    "val_release_timing_faulted": val_release_timing_faulted,
    "val_retro_no_double_recovery_faulted": val_retro_no_double_recovery_faulted,
}
