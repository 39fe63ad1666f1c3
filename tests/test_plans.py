"""Plan shape at the driver-table scale: pushdown, pruning, one treaty shuffle,
broadcast of the (size-checked) GoC state only."""

import re

import pytest

from gocledger.plans.pipeline import Ledger

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def led(spark):
    return Ledger.from_driver(spark, SF)


def test_lineitem_is_read_whole_and_narrow(led):
    p = led.source("cashflow_input")._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in p.splitlines() if "lineitem" in line][0]
    assert "PushedFilters: []" in scan                       # no line item is left out
    assert re.search(r"ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_returnflag:string,"
                     r"l_shipdate:timestamp_ntz>", scan)
    # partial aggregation before the shuffle
    assert p.index("HashAggregate") < p.index("Exchange") or "partial_sum" in p


def test_cashflows_add_up_to_all_of_lineitem(spark, led):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr(
        "sum(case l_returnflag when 'A' then 1 when 'R' then -1 else 0 end * cast(l_extendedprice as decimal(18,2))) as s")
    assert led.source("cashflow_input").selectExpr("sum(amount) as s").first().s == lines.first().s
    years = {r.y for r in led.source("cashflow_input").selectExpr("year(reporting_date) as y").distinct().collect()}
    assert min(years) == 1997 and len(years) >= 4


def test_bound_data_has_all_state_transitions(spark):
    from gocledger.plans import registry
    moves = registry.goc_state_transition(spark, "/root/testdata/sf0.01").select(
        "prev_state", "profitability_state").distinct().collect()
    both = ("PROFITABLE", "ONEROUS")
    assert {(a, b) for a in both for b in both} <= {tuple(r) for r in moves}


def test_ledger_beyond_broadcast_bound_keeps_one_treaty_exchange(spark):
    from gocledger.params import LedgerParams
    wide = Ledger.from_driver(spark, SF, params=LedgerParams(broadcast_max_bytes=0))
    p = plan(wide.int_treaty_bs_state)
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert len([k for k in keys if k.startswith("treaty_id")]) == 1, keys
    # the salted join stands below every window
    lines = p.splitlines()
    assert max(i for i, x in enumerate(lines) if "Window" in x) < min(i for i, x in enumerate(lines) if "_salt" in x and "Join" in x)


def test_treaty_ledger_single_treaty_shuffle(led):
    p = plan(led.int_treaty_bs_state)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    treaty_keyed = [e for e in exchanges if "treaty_id" in e]
    assert len(treaty_keyed) <= 1, exchanges
    assert "BroadcastHashJoin" in p
    assert "Window" in p


def test_goc_state_is_materialised_and_small(led):
    assert led.goc_period_rows <= 30 * 20                   # GoCs x quarters of the whole history
    assert "FileScan parquet" in plan(led.int_goc_bs_state) or "Scan parquet" in plan(led.int_goc_bs_state)


def test_treaty_count_pruned_when_unused(led):
    # the distinct count of M2 is only planned when its column is read
    p = plan(led.int_goc_bs_state)
    assert "count(distinct" not in p.lower()


def test_pnl_is_join_free_over_ledgers(led):
    from gocledger.operators import marts
    df = marts.mart_pnl_quarterly(led.int_goc_bs_state, led.int_treaty_bs_state, led.int_retro_bs_state)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    top = lines[:next(i for i, line in enumerate(lines) if "Union" in line)]
    # the sources are unioned and aggregated once: no join above the union
    assert top and not any("Join" in line for line in top)
    assert any("Aggregate" in line for line in top)


def test_quarterly_mart_joins_goc_dimension_once(led):
    p = led.mart_goc_aoc_quarterly._jdf.queryExecution().optimizedPlan().toString()
    goc_joins = [line for line in p.splitlines() if "Join Inner" in line and "(goc_id#" in line
                 and "reporting_date" not in line]
    assert len(goc_joins) == 1, goc_joins


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def by_treaty(text: str) -> list[str]:
    return [k for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text) if "treaty_id" in k]


def test_bucketed_tables_share_one_treaty_layout(spark, no_broadcast):
    """One treaty-scale exchange, the one that writes the cashflows' buckets: neither the join with the
    treaty master, nor the movements' own buckets, nor the ledger's windows shuffle treaties again."""
    from gocledger.params import LedgerParams
    from gocledger.sources import binding
    cash = binding.bind(spark, SF)["cashflow_input"]
    assert len(by_treaty(plan(cash.repartition(8, "treaty_id")))) == 1
    led = Ledger.from_driver(spark, SF, materialize_raw=True, params=LedgerParams(treaty_buckets=8))
    m1 = plan(led.int_treaty_quarterly_movement)
    assert "SortMergeJoin" in m1 and not by_treaty(m1)
    assert not by_treaty(plan(led.int_treaty_quarterly_movement.repartition(8, "treaty_id")))
    ledger = plan(led.int_treaty_bs_state)
    assert "Window" in ledger and "SelectedBucketsCount: 8 out of 8" in ledger and not by_treaty(ledger)
    plain = Ledger.from_driver(spark, SF).int_treaty_bs_state
    assert sorted(map(str, led.int_treaty_bs_state.collect())) == sorted(map(str, plain.collect()))
    names = {t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")}
    led.release()
    assert len(names) - len({t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")}) == 1


def test_carried_release_adds_no_exchange(spark, no_broadcast):
    from gocledger.params import LedgerParams
    led = Ledger.from_driver(spark, SF, params=LedgerParams(carry_release=True))
    assert len(by_treaty(plan(led.int_treaty_bs_state))) == 1
