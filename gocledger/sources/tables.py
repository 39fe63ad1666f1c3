"""Scans of base tables (S1) and the raw-table profile."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gocledger import schema as S


# ---------------------------------------------------------------------------
# Types of the driver-table columns the binding reads
# ---------------------------------------------------------------------------
DRIVER_COLUMN_TYPES = {
    "lineitem": {"l_suppkey": "bigint", "l_extendedprice": "double", "l_returnflag": "string",
                 "l_shipdate": "timestamp_ntz", "l_linenumber": "int"},
    "supplier": {"s_suppkey": "bigint", "s_nationkey": "int"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "region": {"r_regionkey": "int", "r_name": "string"},
}


def read_parquet(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet`` reading only ``columns``.

    When the column types are declared the read schema is given up front: no
    footer-reading job to infer it, and the scan's ReadSchema is exactly these
    columns.  Otherwise the schema is inferred and the columns selected."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    known = DRIVER_COLUMN_TYPES.get(name, {})
    if columns and all(c in known for c in columns):
        return spark.read.schema(", ".join(f"{c} {known[c]}" for c in columns)).parquet(path)
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_raw(raw: Mapping[str, DataFrame], name: str) -> DataFrame:
    """``source('raw', name)``: one of the five raw inputs, typed to its schema."""
    if name not in S.RAW_SCHEMAS:
        raise KeyError(f"unknown raw table {name!r}")
    df = raw[name]
    return df.select(*[F.col(f.name) for f in S.RAW_SCHEMAS[name].fields])


def raw_row_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per raw table, as one small DataFrame (table_name, row_count)."""
    parts = [
        raw[name].groupBy().agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in S.RAW_TABLES
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
