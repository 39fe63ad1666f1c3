"""Generic data tests (D1-D5) and the declared test suite.

Each generic test returns the failing rows (empty = pass), shaped like the
usual generic-test outputs:

* ``not_null``            -> rows whose column is NULL
* ``unique``              -> (unique_field, n_records) for values seen more than once
* ``accepted_values``     -> (value_field, n_records) for non-NULL values outside the set;
  its failures are these rows, that is the different bad values, not their records
* ``relationships``       -> (from_field, n_records) child values without a parent (NULL children skipped)
* ``unique_combination``  -> (key columns..., n_records) for duplicated key tuples
* ``row_count_between``   -> (n_records) when a table has fewer or more rows than expected

``run_suite`` evaluates a list of declared test instances and returns one row
per instance with its failure count: the rows the generic test returns, except
for relationships, where it is the child records without a parent, and
``row_count_between``, where it is 1 or 0.

The suite reads every model once.  A pass over a model tags each row with the
keys that the model's tests need (a null column, a bad value, the value or key
tuple to be unique, a child or a parent value), and all tags of all models meet
in one aggregation by (test, key) and one by test: duplicates, bad values and
orphans are read off the same counts.  A key shared by a third of the rows is
combined map-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    c = F.col(column)
    return (df.filter(c.isNotNull() & ~c.isin(*values)).groupBy(c.alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def relationships(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """(from_field, n_records) for child values without a parent.

    Child values are counted first (partial aggregation map-side), so a child
    value shared by a third of the rows reaches the anti-join as one row."""
    child = (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("from_field"))
             .agg(F.count(F.lit(1)).alias("n_records")))
    keys = parent.select(F.col(field).alias("from_field"))
    return child.join(keys, "from_field", "left_anti")


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def row_count_between(df: DataFrame, least: int | None = None, most: int | None = None) -> DataFrame:
    """(n_records), one row, if the number of rows is outside the bounds."""
    n = F.col("n_records")
    bad = (n < least if least is not None else F.lit(False)) | (n > most if most is not None else F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n_records")).filter(bad)


@dataclass(frozen=True)
class DataTest:
    model: str
    test: str                      # not_null | unique | accepted_values | relationships | unique_combination
                                   # | row_count_between
    columns: tuple[str, ...] = ()
    values: tuple = ()             # accepted values; row_count_between: (least, most), None for no bound
    parent: str | None = None      # relationships: parent model
    field: str | None = None       # relationships: parent column

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


def _nn(model, *cols):
    return [DataTest(model, "not_null", (c,)) for c in cols]


def _un(model, col):
    return [DataTest(model, "unique", (col,))]


def _av(model, col, values):
    return [DataTest(model, "accepted_values", (col,), tuple(values))]


def _rel(model, col, parent, field):
    return [DataTest(model, "relationships", (col,), parent=parent, field=field)]


def _ucc(model, *cols):
    return [DataTest(model, "unique_combination", tuple(cols))]


# ---------------------------------------------------------------------------
# The declared test instances of every model (114 in all)
# ---------------------------------------------------------------------------
_TYPES = ("ASSUMED", "RETRO")
_INIT_STATES = ("PROFITABLE", "ONEROUS")
_IN_STEPS = ("INIT_RECOG", "VARIANCE")
_QUARTERS = (1, 2, 3, 4)


def _master_tests(prefix: str, with_quarters: bool) -> list[DataTest]:
    goc, treaty, link, cf = (f"{prefix}goc_master", f"{prefix}treaty_master", f"{prefix}retro_link",
                             f"{prefix}cashflow_input")
    t = []
    t += _nn(goc, "goc_id") + _un(goc, "goc_id")
    t += _nn(goc, "goc_type") + _av(goc, "goc_type", _TYPES)
    t += _av(goc, "expected_initial_state", _INIT_STATES)
    t += _nn(treaty, "treaty_id") + _un(treaty, "treaty_id")
    t += _nn(treaty, "treaty_type") + _av(treaty, "treaty_type", _TYPES)
    t += _nn(treaty, "goc_id") + _rel(treaty, "goc_id", goc, "goc_id")
    t += _nn(treaty, "inception_date")
    if with_quarters:
        t += _av(treaty, "inception_quarter", _QUARTERS)
    t += _ucc(link, "assumed_treaty_id", "retro_treaty_id")
    t += _nn(link, "assumed_treaty_id") + _rel(link, "assumed_treaty_id", treaty, "treaty_id")
    t += _nn(link, "retro_treaty_id") + _rel(link, "retro_treaty_id", treaty, "treaty_id")
    t += _nn(link, "retro_cession_rate")
    t += _ucc(cf, "treaty_id", "reporting_date", "aoc_step")
    t += _nn(cf, "treaty_id") + _rel(cf, "treaty_id", treaty, "treaty_id")
    t += _nn(cf, "reporting_date")
    t += _nn(cf, "aoc_step") + _av(cf, "aoc_step", _IN_STEPS)
    t += _nn(cf, "amount")
    if with_quarters:
        t += _av(cf, "reporting_quarter", _QUARTERS)
    return t


def declared_tests() -> list[DataTest]:
    t = _master_tests("", with_quarters=False)
    t += _nn("assumption_version", "version_id") + _un("assumption_version", "version_id")
    t += _master_tests("stg_", with_quarters=True)

    m1, m2 = "int_treaty_quarterly_movement", "int_goc_quarterly_movement"
    t += _ucc(m1, "treaty_id", "reporting_date", "aoc_step")
    t += _nn(m1, "treaty_id", "goc_id", "reporting_date", "aoc_step") + _av(m1, "aoc_step", _IN_STEPS)
    t += _nn(m1, "amount")
    t += _ucc(m2, "goc_id", "reporting_date", "aoc_step")
    t += _nn(m2, "goc_id") + _av(m2, "aoc_step", _IN_STEPS) + _nn(m2, "amount", "treaty_count")
    g = "int_goc_bs_state"
    t += _ucc(g, "goc_id", "reporting_date", "aoc_step")
    t += _nn(g, "goc_id", "reporting_date", "aoc_step")
    t += _av(g, "aoc_step", ("OPENING", "INIT_RECOG", "VARIANCE", "CLOSING"))
    t += _nn(g, "aoc_order") + _av(g, "aoc_order", (1, 2, 3, 5))
    t += _nn(g, "cf_amount", "cf_cumulative")
    tr = "int_treaty_bs_state"
    t += _ucc(tr, "treaty_id", "reporting_date", "aoc_step")
    t += _nn(tr, "treaty_id", "aoc_step")
    t += _av(tr, "aoc_step", ("OPENING", "INIT_RECOG", "VARIANCE", "CSM_RELEASE", "CLOSING"))
    t += _nn(tr, "aoc_order") + _av(tr, "aoc_order", (1, 2, 3, 4, 5))
    rm = "int_retro_quarterly_movement"
    t += _ucc(rm, "retro_treaty_id", "assumed_treaty_id", "reporting_date", "aoc_step")
    t += _nn(rm, "retro_treaty_id", "assumed_treaty_id", "lrc_amount")
    rb = "int_retro_bs_state"
    t += _ucc(rb, "retro_goc_id", "reporting_date", "aoc_step")
    t += _nn(rb, "retro_goc_id", "lrc_amount")
    t += _av(rb, "profitability_state", ("PROFITABLE", "ONEROUS", "BREAK_EVEN"))

    t += _nn("val_bs_invariants", "goc_id", "reporting_date")
    t += _nn("val_profitability_consistency", "goc_id", "reporting_date")
    t += _nn("val_rollforward_continuity", "goc_id")
    t += _nn("val_release_timing", "treaty_id")
    t += _nn("val_treaty_goc_reconciliation", "goc_id")
    t += _nn("val_scenario_expectation", "goc_id")

    t += _nn("mart_goc_aoc_quarterly", "goc_id", "reporting_date", "aoc_step")
    t += _av("mart_goc_aoc_quarterly", "goc_type", _TYPES)
    t += _nn("mart_treaty_aoc_quarterly", "treaty_id", "reporting_date", "aoc_step")
    # One row per year: the keys of the annual marts hold the year beside the GoC (and step).
    t += _nn("mart_goc_annual_summary", "goc_id") + _ucc("mart_goc_annual_summary", "goc_id", "reporting_year")
    t += _av("mart_goc_annual_summary", "final_profitability", ("PROFITABLE", "ONEROUS", "BREAK_EVEN"))
    t += _ucc("mart_annual_aoc_detail", "goc_id", "reporting_year", "aoc_step")
    t += _nn("mart_annual_aoc_detail", "goc_id", "aoc_step")
    t += _nn("mart_pnl_quarterly", "reporting_date") + _un("mart_pnl_quarterly", "reporting_date")
    t += _nn("mart_pnl_quarterly", "insurance_revenue_gross", "recovery_ceded")
    return t


def _key(columns: Sequence[str]) -> Column:
    """The columns' values as one string: lengths keep tuples apart, null is apart from every value."""
    def part(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.concat(*map(part, columns))


def _tag(i: int, key: Column, child: int, parent: int) -> Column:
    return F.struct(F.lit(i).alias("i"), key.alias("key"), F.lit(child).cast("long").alias("child"),
                    F.lit(parent).cast("long").alias("parent"))


def _tags(model: str, tests: Sequence[DataTest]) -> list[Column]:
    """What each row of ``model`` contributes to the tests (null: nothing)."""
    out = []
    for i, t in enumerate(tests):
        col = F.col(t.columns[0]) if t.columns else None
        if t.model == model:
            if t.test == "not_null":
                out.append(F.when(col.isNull(), _tag(i, F.lit(""), 1, 0)))
            elif t.test == "accepted_values":
                out.append(F.when(~col.isin(*t.values), _tag(i, col.cast("string"), 1, 0)))
            elif t.test in ("unique", "relationships"):
                out.append(F.when(col.isNotNull(), _tag(i, col.cast("string"), 1, 0)))
            elif t.test == "unique_combination":
                out.append(_tag(i, _key(t.columns), 1, 0))
            elif t.test == "row_count_between":
                out.append(_tag(i, F.lit(""), 1, 0))
            else:
                raise ValueError(t.test)
        if t.test == "relationships" and t.parent == model:
            out.append(F.when(F.col(t.field).isNotNull(), _tag(i, F.col(t.field).cast("string"), 0, 1)))
    return out


def run_suite(models: Mapping[str, DataFrame], tests: Sequence[DataTest]) -> DataFrame:
    """One row per declared test: (model, test_name, column_name, failures)."""
    tagged: DataFrame | None = None
    for model in dict.fromkeys([t.model for t in tests] + [t.parent for t in tests if t.parent]):
        each = models[model].select(F.explode(F.filter(F.array(*_tags(model, tests)), lambda x: x.isNotNull())).alias("x"))
        tagged = each if tagged is None else tagged.unionByName(each)
    keys = tagged.select("x.*").groupBy("i", "key").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    found = keys.groupBy("i").agg(
        F.sum("child").alias("rows"), F.count(F.lit(1)).alias("keys"), F.count_if(F.col("child") > 1).alias("repeated"),
        F.sum(F.when(F.col("parent") == 0, F.col("child")).otherwise(0)).alias("orphans"))
    low, high = F.col("low"), F.col("high")
    n_rows = F.coalesce("rows", F.lit(0))
    failures = (F.when(F.col("test_name").isin("unique", "unique_combination"), F.col("repeated"))
                .when(F.col("test_name") == "accepted_values", F.col("keys"))
                .when(F.col("test_name") == "relationships", F.col("orphans"))
                .when(F.col("test_name") == "row_count_between",
                      (F.coalesce(n_rows < low, F.lit(False)) | F.coalesce(n_rows > high, F.lit(False))).cast("long"))
                .otherwise(F.col("rows")))
    declared = F.array(*[F.struct(
        F.lit(i).alias("i"), F.lit(t.model).alias("model"), F.lit(t.test).alias("test_name"),
        F.lit(t.column_name).alias("column_name"), *[F.lit(v).cast("long").alias(n) for n, v in zip(
            ("low", "high"), t.values if t.test == "row_count_between" else (None, None))])
        for i, t in enumerate(tests)])
    listed = tagged.sparkSession.range(1).select(F.explode(declared).alias("t")).select("t.*")
    # one row a test on either side
    return listed.join(F.broadcast(found), "i", "left").select(
        "model", "test_name", "column_name", F.coalesce(failures, F.lit(0)).cast("long").alias("failures"))
