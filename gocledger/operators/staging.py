"""Staging (P1-P4): projection + casts to the fixed schema, derived quarters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gocledger import schema as S


def stg_goc_master(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("goc_id").cast("string").alias("goc_id"),
        F.col("goc_type").cast("string").alias("goc_type"),
        F.col("expected_initial_state").cast("string").alias("expected_initial_state"),
        F.col("scenario_description").cast("string").alias("scenario_description"),
    )


def stg_treaty_master(raw: DataFrame) -> DataFrame:
    inception = F.col("inception_date").cast("date")
    return raw.select(
        F.col("treaty_id").cast("string").alias("treaty_id"),
        F.col("treaty_type").cast("string").alias("treaty_type"),
        F.col("goc_id").cast("string").alias("goc_id"),
        inception.alias("inception_date"),
        F.quarter(inception).alias("inception_quarter"),
    )


def stg_retro_link(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("assumed_treaty_id").cast("string").alias("assumed_treaty_id"),
        F.col("retro_treaty_id").cast("string").alias("retro_treaty_id"),
        F.col("retro_cession_rate").cast(S.RATE).alias("retro_cession_rate"),
        F.col("effective_date").cast("date").alias("effective_date"),
    )


def stg_cashflow_input(raw: DataFrame) -> DataFrame:
    rdate = F.col("reporting_date").cast("date")
    return raw.select(
        F.col("treaty_id").cast("string").alias("treaty_id"),
        rdate.alias("reporting_date"),
        F.quarter(rdate).alias("reporting_quarter"),
        F.col("aoc_step").cast("string").alias("aoc_step"),
        F.col("amount").cast(S.MONEY).alias("amount"),
    )
