"""Rows left out: counted while writing, equal to an anti-join, one scan of the source."""

from pyspark.sql import functions as F

from gocledger.operators import rejects
from gocledger.plans import registry
from gocledger.plans.pipeline import Ledger

SF = "/root/testdata/sf0.001"


def test_counts_equal_an_anti_join(spark):
    led = registry._gapped(spark, "/root/testdata/sf0.01")
    counts = led.reject_counts
    orphans = led.stg_cashflow_input.join(led.stg_treaty_master, "treaty_id", "left_anti").count()
    m1 = led.stg_cashflow_input.join(led.stg_treaty_master.select("treaty_id", "goc_id"), "treaty_id")
    m2 = m1.groupBy("goc_id", "reporting_date", "aoc_step").count()
    no_goc = m2.join(led.stg_goc_master, "goc_id", "left_anti")
    no_init = m2.join(led.stg_goc_master, "goc_id", "left_semi").join(
        m1.where("aoc_step = 'INIT_RECOG'").select("goc_id").distinct(), "goc_id", "left_anti")
    assert counts == {rejects.NO_TREATY: orphans, rejects.NO_GOC: no_goc.count(), rejects.NO_INIT: no_init.count()}
    assert all(counts.values())
    got = {r["reason"]: r["count"] for r in led.rejects.groupBy("reason").count().collect()}
    assert got == counts


def test_rejects_read_what_the_run_wrote(spark):
    """No second scan of the source, and only the partitions of rows left out."""
    led = registry._gapped(spark, SF)
    led.int_treaty_bs_state  # noqa: B018 - writes the movements
    plan = led.rejects._jdf.queryExecution().executedPlan().toString()
    assert "l_suppkey" not in plan and "Join" not in plan
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    assert len(scans) == 2 and all("reason" in x.split("PartitionFilters:")[1].split("]")[0] for x in scans)
    ledger = led.int_treaty_bs_state._jdf.queryExecution().executedPlan().toString()
    assert "l_suppkey" not in ledger


def test_clean_inputs_leave_nothing_out(spark, golden):
    led = Ledger.golden(spark, keep_rejects=True)
    assert led.rejects.count() == 0 and set(led.reject_counts.values()) == {0}
    assert sorted(map(str, led.int_treaty_bs_state.collect())) == sorted(map(str, golden.int_treaty_bs_state.collect()))
    assert led.int_goc_bs_state.where(F.col("aoc_step") == "CLOSING").count() == 16
