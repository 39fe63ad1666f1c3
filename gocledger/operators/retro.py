"""Retro recovery (R1-R4): loss recovered from outward (retro) treaties.

Recovery is delta based: only movement steps that *increase* the loss
component of an assumed treaty (``lc_amount < 0`` on INIT_RECOG / VARIANCE)
recover, at ``|lc| * cession rate`` (DECIMAL(24,4), left unrounded), summed per
retro GoC x date x step and rounded to cents only after the sum.

The loss filter is applied to the treaty ledger before any join (it prunes most
rows), the join to the retro links is keyed on the assumed treaty id — the key
the ledger is already partitioned on — and the per-GoC sum is partially
aggregated map-side, so a retro GoC covering a third of all treaties stays
spread over all tasks until its rows are a handful of partial sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gocledger import schema as S
from gocledger.functions import money
from gocledger.operators.joins import bounded_broadcast_join
from gocledger.params import LedgerParams


def retro_treaties(stg_treaty: DataFrame) -> DataFrame:
    """R2: the retro treaty dimension (retro_treaty_id -> retro_goc_id)."""
    return stg_treaty.filter(F.col("treaty_type") == S.RETRO).select(
        F.col("treaty_id").alias("retro_treaty_id"), F.col("goc_id").alias("retro_goc_id"))


def retro_quarterly_movement(treaty_state: DataFrame, stg_retro_link: DataFrame, retro_dim: DataFrame,
                             retro_dim_rows: int, params: LedgerParams = LedgerParams()) -> DataFrame:
    """R1 + R3.  ``retro_dim`` is the (materialised) retro treaty dimension and
    ``retro_dim_rows`` its measured size: retro treaties are few and one of them
    may cover a third of all assumed treaties, so the lookup is a size-checked
    broadcast (salted shuffle beyond the bound), never a join keyed on the hot
    retro treaty id."""
    losses = treaty_state.filter(
        (F.col("lc_amount") < 0) & F.col("aoc_step").isin(*S.INPUT_STEPS)
    ).select("treaty_id", "reporting_date", "reporting_quarter", "aoc_step", "aoc_order", "lc_amount")
    links = stg_retro_link.select("assumed_treaty_id", "retro_treaty_id", "retro_cession_rate")
    with_link = losses.join(links, losses.treaty_id == links.assumed_treaty_id, "inner")
    joined = bounded_broadcast_join(
        with_link, retro_dim, ["retro_treaty_id"], "inner", small_rows=retro_dim_rows,
        max_bytes=params.broadcast_max_bytes, salt_buckets=params.salt_buckets, salt_key="assumed_treaty_id")
    return joined.select(
        "retro_treaty_id",
        "assumed_treaty_id",
        "retro_goc_id",
        "reporting_date",
        "reporting_quarter",
        "aoc_step",
        "aoc_order",
        F.col("lc_amount").alias("assumed_lc_amount"),
        "retro_cession_rate",
        (F.abs(F.col("lc_amount")) * F.col("retro_cession_rate")).alias("lrc_amount"),
    )


def retro_bs_state(retro_movement: DataFrame) -> DataFrame:
    agg = retro_movement.groupBy(
        "retro_goc_id", "reporting_date", "reporting_quarter", "aoc_step", "aoc_order",
    ).agg(F.sum("lrc_amount").alias("lrc_amount"))
    return agg.select(
        "retro_goc_id", "reporting_date", "reporting_quarter", "aoc_step", "aoc_order",
        money(F.col("lrc_amount")).alias("lrc_amount"),
        money(-F.col("lrc_amount")).alias("csm_amount"),
        money(F.lit(0)).alias("lc_amount"),
        F.lit(S.PROFITABLE).alias("profitability_state"),
    )
