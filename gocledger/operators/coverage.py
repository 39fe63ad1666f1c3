"""Release patterns of single treaties, in force from a date.

A pattern gives a treaty's coverage-unit ratio per release quarter and holds from
its effective date until the treaty's next one.  Which pattern holds on a date is
an as-of join.  Intervals are cut into bins (years) and a treaty's bins travel as
one row, so that the join is an equi-join on the treaty alone: rows are dealt by
treaty once, for the join and for the ledger's windows behind it, and a date is
compared with the few intervals of its own year only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ratios are kept at this many decimals.
RATIO = "decimal(9,6)"


def intervals(patterns: DataFrame, last_year: int) -> DataFrame:
    """(treaty_id, year, since, until, ratios): the years that each pattern touches, up to ``last_year``.

    ``patterns``: treaty_id, effective_date, quarter, ratio.  A repeated (treaty, date,
    quarter) counts once, with the larger ratio; a row without treaty, date, quarter or
    ratio does not count."""
    known = patterns.dropna(subset=["treaty_id", "effective_date", "quarter", "ratio"])
    one = known.groupBy("treaty_id", "effective_date", F.col("quarter").cast("int").alias("quarter")).agg(
        F.max(F.col("ratio").cast(RATIO)).alias("ratio"))
    each = one.groupBy("treaty_id", F.col("effective_date").alias("since")).agg(
        F.map_from_entries(F.collect_list(F.struct("quarter", "ratio"))).alias("ratios"))
    until = F.lead("since").over(Window.partitionBy("treaty_id").orderBy("since"))
    each = each.withColumn("until", until)
    end = F.least(F.coalesce(F.year("until"), F.lit(last_year)), F.lit(last_year))
    return each.where(F.year("since") <= last_year).withColumn("year", F.explode(F.sequence(F.year("since"), end)))


def with_ratio(rows: DataFrame, patterns: DataFrame, last_year: int, default: Column) -> DataFrame:
    """``rows`` (treaty_id, reporting_date, reporting_quarter) plus ``ratio``: of the treaty's pattern in
    force, null in a quarter that the pattern does not name; ``default`` without any."""
    cut = intervals(patterns, last_year)
    by_year = cut.groupBy("treaty_id", "year").agg(F.collect_list(F.struct("since", "until", "ratios")).alias("held"))
    bins = by_year.groupBy(F.col("treaty_id").alias("_treaty")).agg(F.map_from_entries(F.collect_list(F.struct("year", "held"))).alias("_bins"))
    date = F.col("reporting_date")
    met = rows.join(bins, rows["treaty_id"] == bins["_treaty"], "left")
    holds = F.filter(F.try_element_at("_bins", F.year(date)),
                     lambda x: (x["since"] <= date) & (x["until"].isNull() | (x["until"] > date)))
    met = met.withColumn("_ratios", F.get(holds, F.lit(0))["ratios"])
    ratio = F.when(F.col("_ratios").isNull(), default.cast(RATIO)).otherwise(F.try_element_at("_ratios", F.col("reporting_quarter")))
    return met.withColumn("ratio", ratio).drop("_treaty", "_bins", "_ratios")
