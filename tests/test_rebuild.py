"""One quarter rebuilt over a published version equals a full run."""

import datetime as dt
import re
import tempfile
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from gocledger.operators import quality, treaty_state
from gocledger.plans.pipeline import BALANCES, Ledger
from gocledger.plans.rebuild import QuarterRebuild
from gocledger.sources import binding, store

SF = "/root/testdata/sf0.001"
FIRST = dt.date(2000, 8, 15)                                # any date of the quarter
START = dt.date(2000, 7, 1)
VALIDATIONS = ("val_treaty_goc_reconciliation", "val_scenario_expectation")


def rows(df):
    return sorted(map(str, df.collect()))


def late_raw(spark):
    """The bound tables with late cashflows from the third quarter of 2000 on: changed, new and vanished rows."""
    raw = dict(binding.bind(spark, SF))
    n = F.substring("treaty_id", 6, 18).cast("long")
    cash = raw["cashflow_input"]
    late = F.col("reporting_date") >= F.lit(START)
    changed = cash.where(~(late & (n % 4 == 1) & (F.month("reporting_date") == 9))).withColumn(
        "amount", F.when(late & (n % 3 == 0), F.col("amount") + F.lit(D("1234.56"))).otherwise(F.col("amount")).cast("decimal(18,2)"))
    extra = cash.where((n % 5 == 2) & (F.col("reporting_date") == F.lit(dt.date(1998, 3, 31)))).select(
        "treaty_id", F.lit(dt.date(2002, 3, 31)).alias("reporting_date"), "aoc_step", "amount")
    return raw | {"cashflow_input": changed.unionByName(extra)}


@pytest.fixture(scope="module")
def versions(spark):
    base = tempfile.mkdtemp(prefix="gocledger-rebuild-")
    Ledger.from_driver(spark, SF, materialize_raw=True).publish_audited(base, tolerate=VALIDATIONS, tests=[])
    return store.VersionedStore(spark, base)


def test_rebuild_equals_a_full_run(spark, versions):
    raw = late_raw(spark)
    before = rows(versions.read("int_treaty_bs_state", 1))
    tests = [t for t in quality.declared_tests() if t.model in ("int_treaty_bs_state", "mart_goc_annual_summary")]
    assert QuarterRebuild(spark, versions, raw, FIRST).publish_next(tolerate=VALIDATIONS, tests=tests) == 2
    full = Ledger(spark, raw)
    full.materialize_all()
    for name in Ledger.MODELS:
        assert rows(versions.read(name, 2)) == rows(full.model(name)), name
    assert rows(versions.read(BALANCES, 2)) == rows(full.treaty_balances)
    assert rows(versions.read("int_treaty_bs_state", 1)) == before
    assert rows(versions.read("int_treaty_bs_state", 2)) != before
    # older quarters are the first version's own files
    one, two = (versions.manifest(v)["models"]["int_treaty_bs_state"]["folders"] for v in (1, 2))
    assert len(two) == 2 and two[0]["path"] == one[0]["path"] and max(two[0]["partitions"]) < f"reporting_date={START}"
    assert min(two[1]["partitions"]) > f"reporting_date={START}"


def test_plan_reads_only_touched_partitions(spark, versions):
    fresh = QuarterRebuild(spark, versions, binding.bind(spark, SF), FIRST)
    plan = fresh.int_treaty_bs_state._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x and "var_period" in x]
    wanted = rf"PartitionFilters: \[[^\]]*\(period#\d+ = {2000 * 4 + 3 - 1}\)\]"     # a folder per version, one partition in all
    assert scans and all(re.search(wanted, x) for x in scans), scans
    assert "treaty_csm_proxy" not in "".join(x for x in plan.splitlines() if "FileScan" in x)   # no older ledger rows
    assert fresh.stg_cashflow_input.agg(F.min("reporting_date")).first()[0] >= START


def test_rebuild_refuses_a_moved_version(spark, versions):
    led = QuarterRebuild(spark, versions, late_raw(spark), FIRST)
    led.version -= 1                                        # as if another publish had come in between
    last = versions.versions()
    with pytest.raises(LookupError):
        led.publish_next(tolerate=VALIDATIONS, tests=[])
    assert versions.versions() == last


def test_balances_of_gaps_and_late_starts(spark):
    cash = [("T", dt.date(2026, 3, 31), "INIT_RECOG", D(10)), ("T", dt.date(2026, 3, 31), "VARIANCE", D(-1)),
            ("T", dt.date(2026, 12, 31), "VARIANCE", D(5)), ("U", dt.date(2026, 9, 30), "INIT_RECOG", D(7))]
    m1 = spark.createDataFrame([(t, "G", "ASSUMED", d, (d.month + 2) // 3, s, a) for t, d, s, a in cash],
                               "treaty_id string, goc_id string, treaty_type string, reporting_date date, reporting_quarter int, "
                               "aoc_step string, amount decimal(18,2)")
    p = 2026 * 4
    got = {(r.treaty_id, r.period - p): (r.amount, r.var_period and r.var_period - p)
           for r in treaty_state.treaty_balances(m1, p + 5).collect()}
    assert got == {("T", 1): (9, 1), ("T", 2): (9, 1), ("T", 3): (9, 1), ("T", 4): (14, 4), ("T", 5): (14, 4),
                   ("U", 3): (7, None), ("U", 4): (7, None), ("U", 5): (7, None)}
