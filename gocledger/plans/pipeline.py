"""The model DAG: raw inputs -> staging -> movements -> ledgers -> marts,
validators and data tests, as one lazily composed set of DataFrames.

Every model is a ``cached_property`` building a DataFrame from its parents, so
Catalyst sees (and optimises) the whole lineage of whatever is asked for.
Nodes read by several consumers are written once as parquet into the shared
folder named by ``spark.checkpoint.dir`` (a reliable lineage cut):

* the treaty cashflow movements (M1) — read by the GoC state and by the treaty
  ledger, so the cashflow source is scanned once, not twice;
* the wide GoC state — tiny (GoCs x periods), read by every treaty row; its row
  count, taken from the materialised table, decides whether it is broadcast;
* optionally the treaty ledger (``materialize_treaty=True``) — the one large
  intermediate, read by retro recovery, three marts and three validators; when
  several of those run in one job it is written once instead of recomputed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gocledger.functions import period_index
from gocledger.operators import (
    explore,
    goc_state,
    marts,
    movement,
    quality,
    rejects,
    retro,
    staging,
    treaty_state,
    validate,
)
from gocledger.params import LedgerParams
from gocledger.session import cut_lineage, cut_lineage_counted, cut_lineage_observed, remove_path, run_folder
from gocledger.sources import binding, deliveries, fixture, sinks, store
from gocledger.sources.tables import raw_row_counts, scan_raw


#: Models with rows of their own for every date: published by date, so that a quarter can be rebuilt alone.
DATED = {name: ("reporting_date",) for name in (
    "stg_cashflow_input", "int_treaty_quarterly_movement", "int_goc_quarterly_movement", "int_treaty_bs_state",
    "int_retro_quarterly_movement", "int_retro_bs_state", "mart_goc_aoc_quarterly", "mart_treaty_aoc_quarterly",
    "mart_pnl_quarterly", "val_retro_recovery_identity", "val_release_timing", "val_treaty_goc_reconciliation")}
#: Published beside the models: the treaties' balances at every quarter's end.
BALANCES = "int_treaty_balance"


class Ledger:
    def __init__(
        self,
        spark: SparkSession,
        raw: dict[str, DataFrame],
        params: LedgerParams | None = None,
        expectations: DataFrame | None = None,
        materialize_treaty: bool = False,
        share_movements: bool = True,
        materialize_retro: bool = False,
        keep_rejects: bool = False,
        patterns: DataFrame | None = None,
    ) -> None:
        self.spark = spark
        self.raw = raw
        self.scratch: list[str] = []       # lineage-cut tables this ledger wrote
        self.published: set[str] = set()   # models whose published table now stands for them
        self.raw_scratch: list[str] = []   # materialised raw inputs (kept while ``raw`` reads them)
        self.params = params or LedgerParams()
        self._expectations = expectations
        self.materialize_treaty = materialize_treaty
        # write the treaty movements once when both the GoC state and the treaty
        # ledger read them; a GoC-only job reads the source a single time anyway
        self.share_movements = share_movements
        # write the retro movements once when several validators read them
        self.materialize_retro = materialize_retro
        # keep the rows that the ledger leaves out, beside those it takes (``rejects``)
        self.keep_rejects = keep_rejects
        # release patterns of single treaties (treaty_id, effective_date, quarter, ratio)
        self.patterns = patterns

    #: Raw tables that grow with the treaties and are joined or aggregated by treaty.
    TREATY_TABLES = ("treaty_master", "cashflow_input")

    @classmethod
    def _bucketed(cls, spark: SparkSession, df: DataFrame, name: str, buckets: int, written: list[str]) -> DataFrame:
        path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
        written.append(path)
        sort_by = [c for c in ("reporting_date", "aoc_step") if c in df.columns]
        return sinks.write_bucketed(df, path, by="treaty_id", buckets=buckets, sort_by=sort_by)

    # -- constructors ---------------------------------------------------------
    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, materialize_raw: bool = False, **kw) -> Ledger:
        """Ledger over the driver tables.  ``materialize_raw`` writes the five
        bound raw tables once (as a production load would) so that many
        consumers read them instead of re-deriving them from ``lineitem``."""
        raw = binding.bind(spark, sf_dir)
        written: list[str] = []
        buckets = kw["params"].treaty_buckets if kw.get("params") else None
        if materialize_raw:
            raw = {name: cut_lineage(df, f"raw_{name}", written) for name, df in raw.items()
                   if not (buckets and name in cls.TREATY_TABLES)} | {
                name: cls._bucketed(spark, raw[name], f"raw_{name}", buckets, written)
                for name in cls.TREATY_TABLES if buckets}
        led = cls(spark, raw, **kw)
        led.raw_scratch.extend(written)
        return led

    @classmethod
    def from_deliveries(cls, spark: SparkSession, raw: Mapping[str, DataFrame], *, version: str | None = None,
                        date: dt.date | None = None, **kw) -> Ledger:
        """Ledger as of a version of its cashflow deliveries (``raw["cashflow_input"]`` with ``version_id``;
        ``raw["assumption_version"]`` lists the versions and their dates)."""
        cash = deliveries.as_of(raw["cashflow_input"], raw["assumption_version"], version=version, date=date)
        return cls(spark, {**raw, "cashflow_input": cash}, **kw)

    @classmethod
    def golden(cls, spark: SparkSession, **kw) -> Ledger:
        kw.setdefault("expectations", fixture.golden_expectations(spark))
        return cls(spark, fixture.golden_raw(spark), **kw)

    # -- sources (S1) and profile (S7) -----------------------------------------
    def source(self, name: str) -> DataFrame:
        return scan_raw(self.raw, name)

    @cached_property
    def raw_row_counts(self) -> DataFrame:
        return raw_row_counts({n: self.source(n) for n in self.raw})

    # -- staging (P1-P4) -------------------------------------------------------
    @cached_property
    def stg_goc_master(self) -> DataFrame:
        return staging.stg_goc_master(self.source("goc_master"))

    @cached_property
    def stg_treaty_master(self) -> DataFrame:
        return staging.stg_treaty_master(self.source("treaty_master"))

    @cached_property
    def stg_retro_link(self) -> DataFrame:
        return staging.stg_retro_link(self.source("retro_link"))

    @cached_property
    def stg_cashflow_input(self) -> DataFrame:
        return staging.stg_cashflow_input(self.source("cashflow_input"))

    # -- movements (M1, M2) ----------------------------------------------------
    @cached_property
    def int_treaty_quarterly_movement(self) -> DataFrame:
        return movement.treaty_quarterly_movement(self.stg_cashflow_input, self.stg_treaty_master)

    @cached_property
    def int_goc_quarterly_movement(self) -> DataFrame:
        return movement.goc_quarterly_movement(self.int_treaty_quarterly_movement, self.stg_goc_master)

    # -- rows left out (K4) ----------------------------------------------------
    @cached_property
    def _flagged_treaty(self) -> tuple[DataFrame, dict]:
        flagged = rejects.flagged_treaty_movement(self.stg_cashflow_input, self.stg_treaty_master)
        return cut_lineage_observed(flagged, "treaty_flagged", rejects.counts(), self.scratch, ("reason",))

    @cached_property
    def _flagged_goc(self) -> tuple[DataFrame, dict]:
        flagged = rejects.flagged_goc_movement(self._movements, self.stg_goc_master)
        return cut_lineage_observed(flagged, "goc_flagged", rejects.counts(), self.scratch, ("reason",))

    @cached_property
    def rejects(self) -> DataFrame:
        """The rows that the ledger leaves out, with the reason; read from where the run wrote them."""
        if not self.keep_rejects:
            raise ValueError("Ledger(keep_rejects=True) keeps the rows left out")
        return rejects.rejected(self._flagged_treaty[0], self._flagged_goc[0])

    @property
    def reject_counts(self) -> dict[str, int]:
        """Rows left out by reason, counted by the jobs that wrote the movements."""
        treaty, goc = self._flagged_treaty[1], self._flagged_goc[1]
        return {r: int(treaty[r]) + int(goc[r]) for r in rejects.REASONS}

    @property
    def _movements(self) -> DataFrame:
        if self.keep_rejects:
            return self._flagged_treaty[0].where(F.col("reason") == rejects.TAKEN).drop("reason")
        if not self.share_movements or "int_treaty_quarterly_movement" in self.published:
            return self.int_treaty_quarterly_movement
        return self.treaty_movement_table

    @cached_property
    def treaty_movement_table(self) -> DataFrame:
        """M1 written once: both the GoC state and the treaty ledger read it, so
        the cashflow source (``lineitem`` in the binding) is scanned once per run.
        In buckets of the treaty id if the run asks for them (``treaty_buckets``): the
        ledger's windows then read it without an exchange."""
        if self.params.treaty_buckets:
            return self._bucketed(self.spark, self.int_treaty_quarterly_movement, "treaty_movement",
                                  self.params.treaty_buckets, self.scratch)
        return cut_lineage(self.int_treaty_quarterly_movement, "treaty_movement", self.scratch)

    # -- GoC state (G1-G15) ----------------------------------------------------
    @cached_property
    def _goc_periods_counted(self) -> tuple[DataFrame, int]:
        if self.keep_rejects:
            taken = self._flagged_goc[0].where(F.col("reason") == rejects.TAKEN).drop("reason")
            return cut_lineage_counted(goc_state.goc_periods(taken), "goc_periods", self.scratch)
        m2 = (self.int_goc_quarterly_movement if "int_goc_quarterly_movement" in self.published
              else movement.goc_quarterly_movement(self._movements, self.stg_goc_master))
        return cut_lineage_counted(goc_state.goc_periods(m2), "goc_periods", self.scratch)

    @cached_property
    def goc_periods(self) -> DataFrame:
        return self._goc_periods_counted[0]

    @cached_property
    def goc_period_rows(self) -> int:
        return self._goc_periods_counted[1]

    @cached_property
    def int_goc_bs_state(self) -> DataFrame:
        return goc_state.goc_bs_state(self.goc_periods)

    # -- treaty state (T1-T11) -------------------------------------------------
    @cached_property
    def int_treaty_bs_state(self) -> DataFrame:
        df = treaty_state.treaty_bs_state(
            self._movements, self.goc_periods, self.goc_period_rows, self.params,
            cut=lambda rows: cut_lineage(rows, "treaty_shares", self.scratch), patterns=self.patterns,
            last_year=(self._last_period - 1) // 4 if self.patterns is not None else 0)
        return cut_lineage(df, "treaty_bs_state", self.scratch) if self.materialize_treaty else df

    # -- retro (R1-R4) ---------------------------------------------------------
    @cached_property
    def _retro_treaties_counted(self) -> tuple[DataFrame, int]:
        return cut_lineage_counted(retro.retro_treaties(self.stg_treaty_master), "retro_treaties", self.scratch)

    @cached_property
    def retro_treaties(self) -> DataFrame:
        return self._retro_treaties_counted[0]

    @cached_property
    def retro_treaty_rows(self) -> int:
        return self._retro_treaties_counted[1]

    @cached_property
    def int_retro_quarterly_movement(self) -> DataFrame:
        df = retro.retro_quarterly_movement(self.int_treaty_bs_state, self.stg_retro_link, self.retro_treaties,
                                            self.retro_treaty_rows, self.params)
        return cut_lineage(df, "retro_movement", self.scratch) if self.materialize_retro else df

    @cached_property
    def int_retro_bs_state(self) -> DataFrame:
        return retro.retro_bs_state(self.int_retro_quarterly_movement)

    # -- marts (A1-A7) ---------------------------------------------------------
    @cached_property
    def goc_csm_release(self) -> DataFrame:
        return marts.goc_csm_release(self.int_treaty_bs_state)

    @cached_property
    def mart_goc_aoc_quarterly(self) -> DataFrame:
        return marts.mart_goc_aoc_quarterly(self.int_goc_bs_state, self.int_treaty_bs_state,
                                            self.int_retro_bs_state, self.stg_goc_master)

    @cached_property
    def mart_treaty_aoc_quarterly(self) -> DataFrame:
        return marts.mart_treaty_aoc_quarterly(self.int_treaty_bs_state, self.stg_treaty_master)

    @cached_property
    def mart_goc_annual_summary(self) -> DataFrame:
        return marts.mart_goc_annual_summary(self.mart_goc_aoc_quarterly)

    @cached_property
    def mart_annual_aoc_detail(self) -> DataFrame:
        return marts.mart_annual_aoc_detail(self.mart_goc_aoc_quarterly)

    @cached_property
    def mart_pnl_quarterly(self) -> DataFrame:
        return marts.mart_pnl_quarterly(self.int_goc_bs_state, self.int_treaty_bs_state, self.int_retro_bs_state)

    # -- validators (V1-V9) ----------------------------------------------------
    @cached_property
    def expectations(self) -> DataFrame:
        """(goc_id, expected_final_state); defaults to each GoC's declared state."""
        if self._expectations is not None:
            return self._expectations
        return self.stg_goc_master.select(
            "goc_id", F.col("expected_initial_state").alias("expected_final_state"))

    @cached_property
    def val_bs_invariants(self) -> DataFrame:
        return validate.val_bs_invariants(self.int_goc_bs_state, self.params)

    @cached_property
    def val_profitability_consistency(self) -> DataFrame:
        return validate.val_profitability_consistency(self.int_goc_bs_state, self.params)

    @cached_property
    def val_rollforward_continuity(self) -> DataFrame:
        return validate.val_rollforward_continuity(self.int_goc_bs_state, self.params)

    @cached_property
    def val_retro_recovery_identity(self) -> DataFrame:
        return validate.val_retro_recovery_identity(self.int_retro_quarterly_movement, self.params)

    @cached_property
    def val_release_timing(self) -> DataFrame:
        return validate.val_release_timing(self.int_treaty_bs_state, self.params)

    @cached_property
    def val_treaty_goc_reconciliation(self) -> DataFrame:
        return validate.val_treaty_goc_reconciliation(self.int_treaty_bs_state, self.int_goc_bs_state, self.params)

    @cached_property
    def val_retro_no_double_recovery(self) -> DataFrame:
        return validate.val_retro_no_double_recovery(self.int_retro_quarterly_movement, self.params)

    @cached_property
    def val_scenario_expectation(self) -> DataFrame:
        return validate.val_scenario_expectation(self.stg_goc_master, self.int_goc_bs_state, self.expectations)

    @cached_property
    def val_summary(self) -> DataFrame:
        return validate.val_summary({name: self.model(name) for name in validate.VALIDATORS})

    # -- notebook walk-through (N1, N2) -----------------------------------------
    @cached_property
    def verify_goc_cashflow(self) -> DataFrame:
        return explore.verify_goc_cashflow(self.source("cashflow_input"), self.source("treaty_master"),
                                           self.source("goc_master"))

    @cached_property
    def verify_cumulative_state(self) -> DataFrame:
        return explore.verify_cumulative_state(self.source("cashflow_input"), self.source("treaty_master"))

    # -- data tests (D1-D5) ------------------------------------------------------
    def data_tests(self, tests: list[quality.DataTest] | None = None) -> DataFrame:
        tests = quality.declared_tests() if tests is None else tests
        names = {t.model for t in tests} | {t.parent for t in tests if t.parent}
        return quality.run_suite({n: self.model(n) for n in names}, tests)

    # -- publish (S3, S5, S6) ----------------------------------------------------
    LAYERS = {
        "stg": ("stg_goc_master", "stg_treaty_master", "stg_retro_link", "stg_cashflow_input"),
        "int": ("int_treaty_quarterly_movement", "int_goc_quarterly_movement", "int_goc_bs_state",
                "int_treaty_bs_state", "int_retro_quarterly_movement", "int_retro_bs_state"),
        "val": (*validate.VALIDATORS, "val_summary"),
        "mart": ("mart_goc_aoc_quarterly", "mart_treaty_aoc_quarterly", "mart_goc_annual_summary",
                 "mart_annual_aoc_detail", "mart_pnl_quarterly"),
    }

    def save_tables(self, prefix: str = "") -> dict[str, str]:
        """Every model as a table of the session's catalog, one database per layer
        (``<prefix>stg``, ``<prefix>int``, ``<prefix>val``, ``<prefix>mart``)."""
        written: dict[str, str] = {}
        for layer, names in self.LAYERS.items():
            for name in names:
                df = self.model(name)
                full = sinks.save_as_table(df, name, layer=f"{prefix}{layer}",
                                           partition_by=sinks.LEDGER_PARTITIONING.get(name, ()))
                self.__dict__[name] = self.spark.table(full).select(*df.columns)
                self.published.add(name)
                written[name] = full
        return written

    #: Models that depend only on the waves before them, so that a wave's tables are written side by side.
    WAVES = (
        LAYERS["stg"],
        ("int_treaty_quarterly_movement",),
        ("int_goc_quarterly_movement",),
        ("int_goc_bs_state",),
        ("int_treaty_bs_state",),
        ("int_retro_quarterly_movement", "val_bs_invariants", "val_profitability_consistency",
         "val_rollforward_continuity", "val_release_timing", "val_treaty_goc_reconciliation",
         "val_scenario_expectation", "mart_treaty_aoc_quarterly"),
        ("int_retro_bs_state", "val_retro_recovery_identity", "val_retro_no_double_recovery"),
        ("val_summary", "mart_goc_aoc_quarterly", "mart_pnl_quarterly"),
        ("mart_goc_annual_summary", "mart_annual_aoc_detail"),
    )

    def publish(self, base: str, partition_by: dict[str, tuple[str, ...]] | None = None,
                release_scratch: bool = False) -> dict[str, str]:
        """Write every model as a parquet table under ``base/<layer>/<model>``
        (full overwrite), wave by wave: what a wave's models read is written by then,
        and its tables are written by jobs side by side.  Each written table replaces
        the model for its downstream readers, so every model is computed exactly once
        and lineage is cut at published tables (the ledgers read the published
        movements, no scratch copy of them).  Large ledgers are partitioned by
        ``reporting_date``."""
        parts = sinks.LEDGER_PARTITIONING if partition_by is None else partition_by
        layer_of = {name: layer for layer, names in self.LAYERS.items() for name in names}
        written: dict[str, str] = {}

        def write(name: str, df: DataFrame) -> DataFrame:
            path = f"{base.rstrip('/')}/{layer_of[name]}/{name}"
            sinks.write_table(df, path, partition_by=parts.get(name, ()))
            return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

        with ThreadPoolExecutor(max(map(len, self.WAVES))) as pool:
            for wave in self.WAVES:
                # Models are built one after another (they share nodes); only the writes run side by side.
                jobs = {name: pool.submit(inheritable_thread_target(self.spark)(write), name, self.model(name)) for name in wave}
                for name, job in jobs.items():
                    self.__dict__[name] = job.result()
                    self.published.add(name)
                    written[name] = f"{base.rstrip('/')}/{layer_of[name]}/{name}"
        if release_scratch:
            self.release()
        return {name: written[name] for names in self.LAYERS.values() for name in names}

    def findings(self, tests: list[quality.DataTest] | None = None) -> dict[str, int]:
        """Failures by validator (V1-V8) and by data test (``model.columns test``; default: all declared
        ones): 0 where all is well."""
        found = {r.validation: r.fail_count for r in self.val_summary.collect()}
        for r in self.data_tests(tests).collect() if tests is None or tests else ():
            found[f"{r.model}.{r.column_name} {r.test_name}"] = r.failures
        return found

    def publish_audited(self, base: str, *, tolerate: Iterable[str] = (), tests: list[quality.DataTest] | None = None,
                        release_scratch: bool = False) -> int:
        """Write, audit, publish: every model into a fresh folder, the validators and data tests
        over the written tables, then one atomic commit; the new version's number.

        Raises :class:`~gocledger.sources.store.PublishRejected` (and publishes nothing)
        if any finding is not named in ``tolerate``.  Read it back with
        :class:`~gocledger.sources.store.VersionedStore`."""
        out = store.VersionedStore(self.spark, base)
        folder = out.new_folder()
        written = self.publish(f"{out.base}/{folder}", partition_by=DATED, release_scratch=release_scratch)
        found = self.findings(tests)
        store.audited(found, tolerate)
        return out.commit(self._entries(out, folder, written), audit=found)

    def _entries(self, out: store.VersionedStore, folder: str, written: dict[str, str]) -> dict[str, dict]:
        """Manifest entries of written tables, and of the treaties' balances, written last."""
        models = {}
        for name, path in written.items():
            at = path[len(out.base) + 1:]
            models[name] = out.entry(self.model(name), [{"path": at, "partitions": out.partitions(at) if name in DATED else None}])
        at = f"{folder}/{BALANCES}"
        sinks.write_table(self.treaty_balances, f"{out.base}/{at}", partition_by=("period",))
        models[BALANCES] = out.entry(self.treaty_balances, [{"path": at, "partitions": out.partitions(at)}])
        return models

    @property
    def _last_period(self) -> int:
        """The last quarter with any movement (GoC-level rows, a few per quarter)."""
        last = self.int_goc_quarterly_movement.agg(F.max(period_index(F.col("reporting_date")))).first()[0]
        return 0 if last is None else int(last)

    @cached_property
    def treaty_balances(self) -> DataFrame:
        """Every treaty's balance at every quarter's end: what a later run of one quarter starts from."""
        return treaty_state.treaty_balances(self._movements, self._last_period)

    _SCRATCH_NODES = ("treaty_movement_table", "_flagged_treaty", "_flagged_goc", "rejects", "_goc_periods_counted", "goc_periods", "goc_period_rows",
                      "_retro_treaties_counted", "retro_treaties", "retro_treaty_rows")

    def release(self) -> None:
        """Delete the intermediate lineage-cut tables this ledger wrote and
        forget the nodes built on them (recomputed if asked for again).  The
        materialised raw inputs (``raw_scratch``) stay: ``raw`` reads them."""
        if self.params.treaty_buckets:
            sinks.drop_bucketed(self.spark, self.scratch)
        for path in self.scratch:
            remove_path(self.spark, path)
        self.scratch.clear()
        for node in self._SCRATCH_NODES:
            self.__dict__.pop(node, None)

    def materialize_all(self) -> dict[str, str]:
        """Publish every model into the shared checkpoint folder (a run-scoped
        lineage cut for jobs that read many models, e.g. the data-test suite)."""
        return self.publish(f"{run_folder(self.spark)}/published-{uuid.uuid4().hex}", release_scratch=True)

    # -- lookup ----------------------------------------------------------------
    MODELS = (
        "stg_goc_master", "stg_treaty_master", "stg_retro_link", "stg_cashflow_input",
        "int_treaty_quarterly_movement", "int_goc_quarterly_movement", "int_goc_bs_state",
        "int_treaty_bs_state", "int_retro_quarterly_movement", "int_retro_bs_state",
        *validate.VALIDATORS, "val_summary",
        "mart_goc_aoc_quarterly", "mart_treaty_aoc_quarterly", "mart_goc_annual_summary",
        "mart_annual_aoc_detail", "mart_pnl_quarterly",
    )

    def model(self, name: str) -> DataFrame:
        if name in self.raw:
            return self.source(name)
        if name not in self.MODELS and name not in ("goc_csm_release", "goc_periods",
                                                    "verify_goc_cashflow", "verify_cumulative_state",
                                                    "raw_row_counts"):
            raise KeyError(f"unknown model {name!r}")
        return getattr(self, name)
