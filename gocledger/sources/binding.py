"""Binding of the driver tables to the five raw ledger inputs.

The driver data is a TPC-H-like star schema; the ledger needs contracts and
signed quarterly cashflows.  The mapping (own design):

* every supplier is an ASSUMED treaty ``TRT_S{suppkey}`` in the GoC of its nation
  ``GOC_N{nationkey}``; every region that has suppliers is a RETRO GoC
  ``GOC_R{regionkey}`` with one retro treaty ``TRT_R{regionkey}``;
* each assumed treaty cedes to the retro treaty of its region at rate
  ``0.25 + 0.05 * regionkey``;
* the signed amount of a line item is ``+price`` for return flag 'A', ``-price``
  for 'R' and 0 for 'N'.  Every line item counts; its ship date only says where:
  what was shipped before the first measurement year (1997) is the treaty's
  INIT_RECOG, dated at the end of that year's first quarter, and everything from
  then on is the VARIANCE of its own quarter, however many years follow.  A line
  without a ship date belongs to the history (INIT_RECOG).

The only large input is ``lineitem``: four columns are read and partially
aggregated per supplier x quarter before the shuffle, so the shuffle carries at
most one row per supplier x quarter x step per map task.  The dimensions are
joined plainly; Spark broadcasts them while their measured size allows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gocledger import schema as S
from gocledger.functions import money, quarter_end
from gocledger.sources.tables import read_parquet

MEASUREMENT_YEAR = 1997


def _lines(spark: SparkSession, sf_dir: str, year: int, more: Sequence[str] = ()) -> DataFrame:
    """Every line item with its quarter, step and signed amount."""
    boundary = dt.date(year, 1, 1)
    li = read_parquet(spark, sf_dir, "lineitem",
                      ["l_suppkey", "l_extendedprice", "l_returnflag", "l_shipdate", *more])
    ship = F.col("l_shipdate").cast("date")
    price = money(F.col("l_extendedprice"))
    is_init = F.coalesce(ship < F.lit(boundary), F.lit(True))
    return li.select(
        "l_suppkey",
        F.when(is_init, F.lit(dt.date(year, 3, 31))).otherwise(quarter_end(ship)).alias("reporting_date"),
        F.when(is_init, F.lit(S.INIT_RECOG)).otherwise(F.lit(S.VARIANCE)).alias("aoc_step"),
        F.when(F.col("l_returnflag") == "A", price)
        .when(F.col("l_returnflag") == "R", -price)
        .otherwise(F.lit(0).cast(S.MONEY)).alias("amount"), *more,
    )


def cashflow_input(spark: SparkSession, sf_dir: str, year: int = MEASUREMENT_YEAR) -> DataFrame:
    """treaty x reporting_date x aoc_step -> amount, from all of lineitem."""
    lines = _lines(spark, sf_dir, year)
    agg = lines.groupBy("l_suppkey", "reporting_date", "aoc_step").agg(F.sum("amount").alias("amount"))
    return agg.select(
        F.concat(F.lit("TRT_S"), F.col("l_suppkey").cast("string")).alias("treaty_id"),
        "reporting_date",
        "aoc_step",
        money(F.col("amount")).alias("amount"),
    )


def cashflow_deliveries(spark: SparkSession, sf_dir: str, year: int = MEASUREMENT_YEAR) -> DataFrame:
    """The cashflows as a series of deliveries: delivery ``V{k}`` holds the keys that have a line with line
    number k, with the sum over all their lines up to number k."""
    lines = _lines(spark, sf_dir, year, ["l_linenumber"])
    each = lines.groupBy("l_suppkey", "reporting_date", "aoc_step", "l_linenumber").agg(F.sum("amount").alias("amount"))
    upto = Window.partitionBy("l_suppkey", "reporting_date", "aoc_step").orderBy("l_linenumber")
    return each.select(
        F.concat(F.lit("V"), F.col("l_linenumber").cast("string")).alias("version_id"),
        F.concat(F.lit("TRT_S"), F.col("l_suppkey").cast("string")).alias("treaty_id"),
        "reporting_date", "aoc_step", money(F.sum("amount").over(upto)).alias("amount"))


def delivery_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version per line number, a day apart."""
    k = F.col("l_linenumber")
    return read_parquet(spark, sf_dir, "lineitem", ["l_linenumber"]).distinct().select(
        F.concat(F.lit("V"), k.cast("string")).alias("version_id"), F.concat(F.lit("lines up to number "), k.cast("string")).alias("description"),
        F.date_add(F.lit(dt.date(2002, 1, 31)), k).alias("as_of_date"))


def _suppliers_with_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    supp = read_parquet(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    nation = read_parquet(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    return supp.join(nation, supp.s_nationkey == nation.n_nationkey, "inner")


def _regions_used(spark: SparkSession, sf_dir: str, supp_nat: DataFrame) -> DataFrame:
    region = read_parquet(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    used = supp_nat.select(F.col("n_regionkey")).distinct()
    return used.join(region, used.n_regionkey == region.r_regionkey, "inner")


def goc_master(spark: SparkSession, sf_dir: str, supp_nat: DataFrame | None = None) -> DataFrame:
    supp_nat = supp_nat if supp_nat is not None else _suppliers_with_nation(spark, sf_dir)
    nations = supp_nat.select("n_nationkey", "n_name").distinct()
    assumed = nations.select(
        F.concat(F.lit("GOC_N"), F.col("n_nationkey").cast("string")).alias("goc_id"),
        F.lit(S.ASSUMED).alias("goc_type"),
        F.when(F.col("n_nationkey") % 2 == 0, F.lit(S.PROFITABLE))
        .otherwise(F.lit(S.ONEROUS)).alias("expected_initial_state"),
        F.col("n_name").alias("scenario_description"),
    )
    retro = _regions_used(spark, sf_dir, supp_nat).select(
        F.concat(F.lit("GOC_R"), F.col("r_regionkey").cast("string")).alias("goc_id"),
        F.lit(S.RETRO).alias("goc_type"),
        F.lit(S.PROFITABLE).alias("expected_initial_state"),
        F.col("r_name").alias("scenario_description"),
    )
    return assumed.unionByName(retro)


def treaty_master(spark: SparkSession, sf_dir: str, year: int = MEASUREMENT_YEAR,
                  supp_nat: DataFrame | None = None) -> DataFrame:
    supp_nat = supp_nat if supp_nat is not None else _suppliers_with_nation(spark, sf_dir)
    inception = F.lit(dt.date(year, 1, 1))
    assumed = supp_nat.select(
        F.concat(F.lit("TRT_S"), F.col("s_suppkey").cast("string")).alias("treaty_id"),
        F.lit(S.ASSUMED).alias("treaty_type"),
        F.concat(F.lit("GOC_N"), F.col("n_nationkey").cast("string")).alias("goc_id"),
        inception.alias("inception_date"),
    )
    retro = _regions_used(spark, sf_dir, supp_nat).select(
        F.concat(F.lit("TRT_R"), F.col("r_regionkey").cast("string")).alias("treaty_id"),
        F.lit(S.RETRO).alias("treaty_type"),
        F.concat(F.lit("GOC_R"), F.col("r_regionkey").cast("string")).alias("goc_id"),
        inception.alias("inception_date"),
    )
    return assumed.unionByName(retro)


def retro_link(spark: SparkSession, sf_dir: str, year: int = MEASUREMENT_YEAR,
               supp_nat: DataFrame | None = None) -> DataFrame:
    supp_nat = supp_nat if supp_nat is not None else _suppliers_with_nation(spark, sf_dir)
    rate = F.lit(Decimal("0.25")) + F.lit(Decimal("0.05")) * F.col("n_regionkey")
    return supp_nat.select(
        F.concat(F.lit("TRT_S"), F.col("s_suppkey").cast("string")).alias("assumed_treaty_id"),
        F.concat(F.lit("TRT_R"), F.col("n_regionkey").cast("string")).alias("retro_treaty_id"),
        rate.cast(S.RATE).alias("retro_cession_rate"),
        F.lit(dt.date(year, 1, 1)).alias("effective_date"),
    )


def assumption_version(spark: SparkSession, year: int = MEASUREMENT_YEAR) -> DataFrame:
    """Version metadata: one row describing this binding."""
    return spark.createDataFrame(
        [("V1", f"Driver-table binding, first measurement year {year}", dt.date(year + 1, 1, 31))],
        S.ASSUMPTION_VERSION,
    )


class _LazyTables(Mapping):
    """name -> DataFrame, each built on first access (unused inputs cost nothing)."""

    def __init__(self, factories: dict) -> None:
        self._factories = factories
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)


def bind(spark: SparkSession, sf_dir: str, year: int = MEASUREMENT_YEAR) -> Mapping[str, DataFrame]:
    """All five raw inputs as lazy DataFrames (the supplier x nation frame is
    shared by the three master tables)."""
    shared: dict[str, DataFrame] = {}

    def supp_nat() -> DataFrame:
        if "supp_nat" not in shared:
            shared["supp_nat"] = _suppliers_with_nation(spark, sf_dir)
        return shared["supp_nat"]

    return _LazyTables({
        "goc_master": lambda: goc_master(spark, sf_dir, supp_nat()),
        "treaty_master": lambda: treaty_master(spark, sf_dir, year, supp_nat()),
        "retro_link": lambda: retro_link(spark, sf_dir, year, supp_nat()),
        "cashflow_input": lambda: cashflow_input(spark, sf_dir, year),
        "assumption_version": lambda: assumption_version(spark, year),
    })
