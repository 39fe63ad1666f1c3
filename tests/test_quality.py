"""Generic data tests: one row violating each of the five tests."""

import datetime as dt
from decimal import Decimal as D

from gocledger import schema as S
from gocledger.operators import quality
from gocledger.plans.pipeline import Ledger


def test_each_generic_test_fires(spark):
    d = dt.date(2026, 3, 31)
    raw = {
        "goc_master": spark.createDataFrame(
            [("G1", "ASSUMED", "PROFITABLE", "x"), ("G1", "ASSUMED", "PROFITABLE", "dup")], S.GOC_MASTER),
        "treaty_master": spark.createDataFrame(
            [("T1", "ASSUMED", "G1", dt.date(2026, 1, 1)), ("T2", "ASSUMED", "G1", None)], S.TREATY_MASTER),
        "retro_link": spark.createDataFrame([("T1", "T_MISSING", D("0.30"), d)], S.RETRO_LINK),
        "cashflow_input": spark.createDataFrame(
            [("T1", d, "INIT_RECOG", D(1)), ("T1", d, "INIT_RECOG", D(2)), ("T2", d, "OTHER", D(3)),
             ("T1", d, "OTHER", D(4))],
            S.CASHFLOW_INPUT),
        "assumption_version": spark.createDataFrame([("V1", "q", d)], S.ASSUMPTION_VERSION),
    }
    led = Ledger(spark, raw)
    raw_tests = [t for t in quality.declared_tests() if t.model in raw]
    got = {(r.model, r.test_name, r.column_name): r.failures for r in led.data_tests(raw_tests).collect()}
    assert got[("goc_master", "unique", "goc_id")] == 1
    assert got[("treaty_master", "not_null", "inception_date")] == 1
    # a failure is a bad value, as in the rows that the test itself returns
    assert got[("cashflow_input", "accepted_values", "aoc_step")] == 1
    assert got[("retro_link", "relationships", "retro_treaty_id")] == 1
    assert got[("cashflow_input", "unique_combination", "treaty_id,reporting_date,aoc_step")] == 1
    assert sum(got.values()) == 5

    cf = led.source("cashflow_input")
    assert [tuple(r) for r in quality.accepted_values(cf, "aoc_step", S.INPUT_STEPS).collect()] == [("OTHER", 2)]
    assert quality.unique_combination(cf, ["treaty_id", "reporting_date", "aoc_step"]).count() == 1
    assert [tuple(r) for r in quality.relationships(
        led.source("retro_link"), "retro_treaty_id", led.source("treaty_master"), "treaty_id").collect()] == \
        [("T_MISSING", 1)]


def test_declared_suite_size():
    tests = quality.declared_tests()
    assert len(tests) == 114
    by = {}
    for t in tests:
        by[t.test] = by.get(t.test, 0) + 1
    assert by == {"not_null": 69, "unique": 6, "accepted_values": 19, "relationships": 8,
                  "unique_combination": 12}


def test_row_count_expectation(spark):
    df = spark.range(5).withColumnRenamed("id", "a")
    assert quality.row_count_between(df, 5, 5).count() == 0 and quality.row_count_between(df).count() == 0
    assert [r.n_records for r in quality.row_count_between(df, 6).collect()] == [5]
    tests = [quality.DataTest("m", "row_count_between", values=v) for v in ((1, 4), (5, None), (None, 5), (6, None))]
    tests.append(quality.DataTest("none", "row_count_between", values=(1, None)))
    tests.append(quality.DataTest("none", "row_count_between", values=(0, 0)))
    got = quality.run_suite({"m": df, "none": df.limit(0)}, tests).collect()
    assert [r.failures for r in got] == [1, 0, 0, 1, 1, 0]


def test_suite_reads_every_table_once(spark):
    """One scan of each written table, one aggregation by key."""
    from gocledger.plans import registry
    df = registry.dq_test_summary(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    files = df.inputFiles()
    assert plan.count("Relation [") == len(quality_models()), plan.count("Relation [")
    assert len({f.rsplit("/part-", 1)[0].split("reporting_date=")[0] for f in files}) <= len(quality_models())
    assert plan.count("Join ") == 1 and plan.count("Aggregate [") == 2


def quality_models():
    tests = quality.declared_tests()
    return {t.model for t in tests} | {t.parent for t in tests if t.parent}


def test_suite_agrees_with_the_single_tests(spark):
    rows = [(None, "x", 1), ("a", "x", 1), ("a", None, 2), ("b", "y", 1), ("b", "y", 1), (None, "x", 1)]
    df = spark.createDataFrame(rows, "k string, v string, n int")
    parents = spark.createDataFrame([("a",), (None,), ("c",)], "id string")
    tests = [quality.DataTest("m", "not_null", ("k",)), quality.DataTest("m", "unique", ("k",)),
             quality.DataTest("m", "accepted_values", ("v",), ("x",)), quality.DataTest("m", "unique_combination", ("k", "v", "n")),
             quality.DataTest("m", "relationships", ("k",), parent="p", field="id"), quality.DataTest("p", "not_null", ("id",))]
    got = [r.failures for r in quality.run_suite({"m": df, "p": parents}, tests).collect()]
    assert got == [quality.not_null(df, "k").count(), quality.unique(df, "k").count(), quality.accepted_values(df, "v", ["x"]).count(),
                   quality.unique_combination(df, ["k", "v", "n"]).count(),
                   sum(r.n_records for r in quality.relationships(df, "k", parents, "id").collect()), 1]
    assert got == [2, 2, 1, 2, 2, 1]
