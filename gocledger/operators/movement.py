"""Movements, cashflow view (M1, M2).

M1 attaches the GoC to each treaty cashflow (inner join: orphan cashflows drop
out).  Both sides grow with the number of treaties, so no broadcast is forced:
Catalyst/AQE pick a broadcast only when the treaty master is measured small,
otherwise a shuffle join on ``treaty_id``.

M2 sums treaty cashflows to GoC x date x step.  It aggregates *before* joining
the GoC dimension, so the treaty-level rows are partially aggregated map-side
and a hot GoC (one GoC holding a third of all treaties) never lands whole in one
task.  ``treaty_count`` is a distinct count; Catalyst prunes it (and the extra
shuffle it needs) whenever a consumer does not read the column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def treaty_quarterly_movement(stg_cashflow: DataFrame, stg_treaty: DataFrame) -> DataFrame:
    treaties = stg_treaty.select("treaty_id", "treaty_type", "goc_id")
    joined = stg_cashflow.join(treaties, "treaty_id", "inner")
    return joined.select(
        "treaty_id", "goc_id", "treaty_type", "reporting_date", "reporting_quarter", "aoc_step", "amount",
    )


def goc_quarterly_movement(treaty_movement: DataFrame, stg_goc: DataFrame) -> DataFrame:
    per_goc = treaty_movement.groupBy(
        "goc_id", "reporting_date", "reporting_quarter", "aoc_step",
    ).agg(
        F.sum("amount").alias("amount"),
        F.countDistinct("treaty_id").alias("treaty_count"),
    )
    gocs = stg_goc.select("goc_id", "goc_type")
    return per_goc.join(gocs, "goc_id", "inner").select(
        "goc_id", "goc_type", "reporting_date", "reporting_quarter", "aoc_step", "amount", "treaty_count",
    )
