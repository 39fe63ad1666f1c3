"""Sinks (S3, S5, S6): overwrite a model as a columnar table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Full overwrite of a columnar table at ``path``.

    Large ledgers are partitioned by ``reporting_date`` so readers of one
    quarter prune every other quarter's files.  Rows are rebalanced by the
    partition columns first (AQE splits a large date and merges small ones), so a
    date is a few files of even size, not one from every task.
    """
    df = _clustered(df, partition_by)
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def _clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *partition_by) if partition_by else df


def save_as_table(df: DataFrame, name: str, *, layer: str | None = None, partition_by: Sequence[str] = (),
                  fmt: str = "parquet") -> str:
    """CTAS-style materialisation into the catalog; ``layer`` (stg/int/val/mart)
    becomes the database, mirroring one schema per layer."""
    spark = df.sparkSession
    full = name
    if layer:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        full = f"{layer}.{name}"
    w = _clustered(df, partition_by).write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(full)
    return full


def write_bucketed(df: DataFrame, path: str, *, by: str, buckets: int, sort_by: Sequence[str] = ()) -> DataFrame:
    """A table at ``path`` in ``buckets`` buckets of ``by``, one file a bucket, sorted within; read back.

    Rows that are partitioned so already are written as they lie: Spark leaves out a
    repartition that changes nothing.  Buckets are known to the catalog only, so the
    table is entered there under a name of its own (``drop_bucketed`` removes it)."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, by).sortWithinPartitions(by, *sort_by)
     .write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, by).sortBy(by, *sort_by).saveAsTable(name))
    return spark.table(name).select(*df.columns)


def drop_bucketed(spark: SparkSession, paths: Sequence[str]) -> None:
    """Take the bucketed tables at these paths out of the catalog (their files stay)."""
    gone = {p.removeprefix("file:").rstrip("/") for p in paths}
    for t in spark.catalog.listTables():
        if t.name.startswith("bucketed_"):
            row = spark.sql(f"DESCRIBE TABLE EXTENDED {t.name}").where("col_name = 'Location'").first()
            if row is not None and row.data_type.removeprefix("file:").rstrip("/") in gone:
                spark.sql(f"DROP TABLE IF EXISTS {t.name}")


LEDGER_PARTITIONING = {
    "int_treaty_bs_state": ("reporting_date",),
    "mart_treaty_aoc_quarterly": ("reporting_date",),
}
