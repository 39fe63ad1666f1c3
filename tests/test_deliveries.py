"""As-of selection over versioned deliveries; two versions, two reproducible ledgers."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from gocledger import schema as S
from gocledger.plans.pipeline import Ledger
from gocledger.sources import deliveries

Q4 = dt.date(2026, 12, 31)


@pytest.fixture(scope="module")
def raw(spark, golden):
    """V1: the golden cashflows.  V2 restates two of the last quarter, adds one and withdraws one."""
    first = golden.source("cashflow_input").withColumn("version_id", F.lit("V1"))
    again = spark.createDataFrame(
        [("TRT_A1", Q4, "VARIANCE", D("-6500.00")), ("TRT_C1", Q4, "VARIANCE", D("-9000.00")), ("TRT_A2", Q4, "VARIANCE", None),
         ("TRT_A2", dt.date(2027, 3, 31), "VARIANCE", D("-100.00"))], S.CASHFLOW_INPUT).withColumn("version_id", F.lit("V2"))
    ahead = spark.createDataFrame([("TRT_B1", Q4, "VARIANCE", D("1.00"))], S.CASHFLOW_INPUT).withColumn("version_id", F.lit("V3"))
    versions = spark.createDataFrame([("V2", "restated", dt.date(2027, 2, 28)), ("V1", "first", dt.date(2027, 1, 31))], S.ASSUMPTION_VERSION)
    return dict(golden.raw) | {"cashflow_input": first.unionByName(again).unionByName(ahead), "assumption_version": versions}


def rows(df):
    return sorted(map(str, df.collect()))


def test_two_versions_give_two_reproducible_ledgers(spark, raw, golden):
    one = Ledger.from_deliveries(spark, raw, version="V1")
    assert rows(one.int_treaty_bs_state) == rows(golden.int_treaty_bs_state)
    two = Ledger.from_deliveries(spark, raw, version="V2")
    got = {(r.treaty_id, r.reporting_date): r.amount for r in two.source("cashflow_input").where("aoc_step = 'VARIANCE'").collect()}
    assert got["TRT_A1", Q4] == D("-6500.00") and got["TRT_C1", Q4] == D("-9000.00") and got["TRT_B1", Q4] == D("-3000.00")
    assert ("TRT_A2", Q4) not in got and got["TRT_A2", dt.date(2027, 3, 31)] == D("-100.00") and len(got) == 28
    plain = {r.treaty_id: r for r in two.int_treaty_bs_state.where("aoc_step = 'CLOSING' and reporting_date = '2026-12-31'").collect()}
    assert plain["TRT_A1"].cf_amount == D("33500.00") and "TRT_A2" not in plain
    assert rows(two.int_treaty_bs_state) == rows(Ledger.from_deliveries(spark, raw, version="V2").int_treaty_bs_state)
    assert rows(two.int_treaty_bs_state) != rows(one.int_treaty_bs_state)


def test_dates_and_unknown_versions(spark, raw):
    cash, versions = raw["cashflow_input"], raw["assumption_version"]
    by_date = lambda d: deliveries.as_of(cash, versions, date=d)
    assert by_date(dt.date(2027, 1, 1)).count() == 0
    assert rows(by_date(dt.date(2027, 2, 1))) == rows(deliveries.as_of(cash, versions, version="V1"))
    assert rows(by_date(dt.date(2030, 1, 1))) == rows(deliveries.as_of(cash, versions, version="V2"))
    for bad in ({"version": "V9"}, {}, {"version": "V1", "date": Q4}):
        with pytest.raises(ValueError):
            deliveries.as_of(cash, versions, **bad)


def test_last_delivery_is_picked_without_a_window(spark, raw):
    plan = deliveries.as_of(raw["cashflow_input"], raw["assumption_version"], version="V2")._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Join")[0]
    assert "Aggregate" in above and "Window" not in above
