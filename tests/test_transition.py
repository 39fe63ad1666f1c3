"""Closed form vs the four-way transition table, exhaustively on an integer grid
including every zero boundary (evaluated by Spark, checked in Python)."""

from pyspark.sql import functions as F

from gocledger.functions import csm_movement, lc_movement, state_of


def table(before, v):
    after = before + v
    prev = "P" if before > 0 else ("O" if before < 0 else "B")
    new = "P" if after > 0 else ("O" if after < 0 else "B")
    prev_csm = -before if before > 0 else 0
    prev_lc = before if before < 0 else 0
    if prev in "PB" and new == "P":
        return -v, 0
    if prev in "PB" and after <= 0:
        return -prev_csm, after
    if prev == "O" and new in "OB":
        return 0, v
    return -after, -prev_lc


def test_closed_form_equals_transition_table(spark):
    grid = spark.range(-30, 31).withColumnRenamed("id", "before").crossJoin(
        spark.range(-70, 71).withColumnRenamed("id", "v"))
    out = grid.select(
        "before", "v",
        csm_movement(F.col("before"), F.col("before") + F.col("v")).alias("csm"),
        lc_movement(F.col("before"), F.col("before") + F.col("v")).alias("lc"),
        state_of(F.col("before") + F.col("v")).alias("state"),
    ).collect()
    assert len(out) == 61 * 141
    bad = [(r.before, r.v) for r in out if (r.csm, r.lc) != table(r.before, r.v)]
    assert bad == []
    assert {r.state for r in out} == {"PROFITABLE", "ONEROUS", "BREAK_EVEN"}
