"""Versioned deliveries (S1): the cashflows as they were known at a version.

A source delivers cashflows again and again; each delivery has a version and an
as-of date and holds the keys it knows anew, or differently.  What holds as of a
version is, for every key, the row of the last delivery up to it.  One partial
aggregation by key picks it (the amount of the greatest delivery number), so a key
that was delivered a thousand times is one row per task, and no window sorts a
hot key's history.  An amount of null withdraws a key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ("treaty_id", "reporting_date", "aoc_step")


def numbered(versions: DataFrame) -> DataFrame:
    """(version_id, as_of_date, delivery): deliveries counted in order of their date, then version.
    One row per delivery: a list that people keep, not data."""
    one = versions.groupBy("version_id").agg(F.min("as_of_date").alias("as_of_date"))
    return one.withColumn("delivery", F.row_number().over(Window.orderBy("as_of_date", "version_id")).cast("long"))


def as_of(deliveries: DataFrame, versions: DataFrame, *, version: str | None = None, date: dt.date | None = None,
          key: Sequence[str] = KEY, amount: str = "amount") -> DataFrame:
    """The rows (``key`` and ``amount``) that hold as of a version, or of a date (its last delivery).

    ``deliveries`` carry ``version_id``; rows of a version that is not listed are not
    delivered yet.  A key repeated within one delivery has the larger amount.
    ValueError for an unknown version."""
    if (version is None) == (date is None):
        raise ValueError("either a version or a date")
    order = numbered(versions)
    last = order.where(F.col("version_id") == version if version is not None else F.col("as_of_date") <= F.lit(date))
    upto = last.agg(F.max("delivery")).first()[0]
    if upto is None and version is not None:
        raise ValueError(f"unknown version {version!r}")
    known = order.where(F.col("delivery") <= F.lit(upto if upto is not None else 0)).select("version_id", "delivery")
    found = deliveries.join(known, "version_id").groupBy(*key).agg(
        F.max_by(amount, F.struct("delivery", F.coalesce(F.col(amount), F.lit(0)))).alias(amount))
    return found.where(F.col(amount).isNotNull())
