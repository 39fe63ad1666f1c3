"""Release patterns of single treaties, in force from a date."""

import datetime as dt
from decimal import Decimal as D

from gocledger.operators import coverage
from gocledger.plans.pipeline import Ledger
from pyspark.sql import functions as F

SCHEMA = "treaty_id string, effective_date date, quarter int, ratio decimal(9,6)"


def test_uniform_pattern_gives_the_same_ledger(spark, golden):
    treaties = [r.treaty_id for r in golden.stg_treaty_master.collect()]
    rows = [(t, dt.date(2020, 1, 1), q, r) for t in treaties for q, r in ((2, D("0.55")), (4, D("0.45")))]
    led = Ledger.golden(spark, patterns=spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(str, led.int_treaty_bs_state.collect())) == sorted(map(str, golden.int_treaty_bs_state.collect()))


def test_pattern_of_one_treaty(spark, golden):
    """A1 releases all in Q3 from 2026-07 on (proxy -47,000), nothing else; the others as before."""
    rows = [("TRT_A1", dt.date(2026, 1, 1), 4, D("0.10")), ("TRT_A1", dt.date(2026, 7, 1), 3, D("1.0"))]
    led = Ledger.golden(spark, patterns=spark.createDataFrame(rows, SCHEMA))
    got = {(r.treaty_id, r.reporting_quarter): r.csm_amount for r in led.int_treaty_bs_state.where("aoc_step = 'CSM_RELEASE'").collect()}
    old = {(r.treaty_id, r.reporting_quarter): r.csm_amount for r in golden.int_treaty_bs_state.where("aoc_step = 'CSM_RELEASE'").collect()}
    assert {k: v for k, v in got.items() if k[0] != "TRT_A1"} == {k: v for k, v in old.items() if k[0] != "TRT_A1"}
    assert {k[1]: v for k, v in got.items() if k[0] == "TRT_A1"} == {3: D("47000.00")}


def test_as_of_join_matches_brute_force(spark):
    import random
    rng = random.Random(3)
    start = dt.date(1999, 1, 1)
    patterns = [(f"t{rng.randrange(6)}", start + dt.timedelta(rng.randrange(2500)), rng.randrange(1, 5), D(rng.randrange(1, 100)) / 100)
                for _ in range(60)] + [(None, start, 1, D("0.5")), ("t0", None, 1, D("0.5")), ("t1", start, None, D("0.5")), ("t1", start, 1, None)]
    rows = [(f"t{rng.randrange(8)}", start + dt.timedelta(rng.randrange(-300, 3000))) for _ in range(400)]
    df = spark.createDataFrame(rows, "treaty_id string, reporting_date date").withColumn("reporting_quarter", F.quarter("reporting_date"))
    out = coverage.with_ratio(df, spark.createDataFrame(patterns, SCHEMA), 2007, F.lit(D("0.7")))
    good = [p for p in patterns if None not in p]

    def ratio(t, d):
        dates = [e for u, e, _, _ in good if u == t and e <= d]
        if not dates:
            return D("0.7")
        own = [r for u, e, q, r in good if u == t and e == max(dates) and q == (d.month + 2) // 3]
        return max(own, default=None)

    assert sorted(map(str, [(r.treaty_id, r.reporting_date, r.ratio and r.ratio.normalize()) for r in out.collect()])) == \
        sorted(map(str, [(t, d, ratio(t, d) and ratio(t, d).normalize()) for t, d in rows]))


def test_join_and_windows_share_the_layout(spark):
    import re
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from gocledger.plans import registry
        plan = registry.int_treaty_bs_state_patterns(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    top = plan[:plan.index("SortMergeJoin")]
    assert "Window" in top and not re.search(r"Exchange hashpartitioning\(treaty_id", top)
