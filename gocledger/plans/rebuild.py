"""Rebuild of the quarters from a given one on, over a published version (S3).

A changed quarter changes its own rows and those of later quarters of its treaties
and GoCs, and nothing before.  The treaties' past enters as one balance row each,
read from the one partition of the quarter before; the GoCs' past is their published
movements (a few rows a quarter).  Only the cashflows from the quarter on are read,
only the partitions from it on are written, and the new version's manifest points at
the old partitions for all that lies before.

Two tables sum over all quarters, V7 and the annual marts: they are made again, the
annual marts from the GoC-level quarterly mart, V7 from the retro movements of all
quarters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gocledger.functions import period_index
from gocledger.operators import goc_state, marts, movement, quality, treaty_state, validate
from gocledger.plans.pipeline import BALANCES, DATED, Ledger
from gocledger.session import cut_lineage, cut_lineage_counted
from gocledger.sources import store


class QuarterRebuild(Ledger):
    """The ledger from the quarter of ``first`` on.  ``raw``: the five raw inputs; of the cashflows only
    those from that quarter on are read.  Dated models hold the rows from ``first`` on."""

    def __init__(self, spark: SparkSession, published: store.VersionedStore, raw: Mapping[str, DataFrame],
                 first: dt.date, **kw) -> None:
        super().__init__(spark, dict(raw), **kw)
        self.store, self.first, self.version = published, first, published.versions()[-1]
        self.before = published.manifest(self.version)
        self.period = first.year * 4 + (first.month + 2) // 3
        self.start = dt.date(first.year, (first.month - 1) // 3 * 3 + 1, 1)

    def source(self, name: str) -> DataFrame:
        df = super().source(name)
        return df.where(F.col("reporting_date") >= F.lit(self.start)) if name == "cashflow_input" else df

    def _old(self, name: str) -> DataFrame:
        """A dated model's published rows before the quarter."""
        return self.store.table(self.before, name).where(F.col("reporting_date") < F.lit(self.start))

    @cached_property
    def carry_in(self) -> DataFrame:
        return self.store.table(self.before, BALANCES).where(F.col("period") == self.period - 1)

    @cached_property
    def _all_goc_movements(self) -> DataFrame:
        new = movement.goc_quarterly_movement(self._movements, self.stg_goc_master)
        return cut_lineage(self._old("int_goc_quarterly_movement").unionByName(new), "goc_movements", self.scratch)

    @cached_property
    def int_goc_quarterly_movement(self) -> DataFrame:
        return self._all_goc_movements.where(F.col("reporting_date") >= F.lit(self.start))

    @cached_property
    def _goc_periods_counted(self) -> tuple[DataFrame, int]:
        return cut_lineage_counted(goc_state.goc_periods(self._all_goc_movements), "goc_periods", self.scratch)

    @cached_property
    def int_treaty_bs_state(self) -> DataFrame:
        return treaty_state.treaty_bs_state(
            self._movements, self.goc_periods, self.goc_period_rows, self.params,
            cut=lambda rows: cut_lineage(rows, "treaty_shares", self.scratch), carry_in=self.carry_in)

    @cached_property
    def treaty_balances(self) -> DataFrame:
        known = self._all_goc_movements.agg(F.max(period_index(F.col("reporting_date")))).first()[0]
        made = treaty_state.treaty_balances(self._movements, int(known), self.carry_in)
        return made.where(F.col("period") >= self.period)

    @property
    def _goc_from_first(self) -> DataFrame:
        return self.int_goc_bs_state.where(F.col("reporting_date") >= F.lit(self.start))

    @cached_property
    def mart_goc_aoc_quarterly(self) -> DataFrame:
        return marts.mart_goc_aoc_quarterly(self._goc_from_first, self.int_treaty_bs_state, self.int_retro_bs_state,
                                            self.stg_goc_master)

    @cached_property
    def mart_pnl_quarterly(self) -> DataFrame:
        return marts.mart_pnl_quarterly(self._goc_from_first, self.int_treaty_bs_state, self.int_retro_bs_state)

    def _whole(self, name: str) -> DataFrame:
        return self._old(name).unionByName(self.model(name))

    @cached_property
    def mart_goc_annual_summary(self) -> DataFrame:
        return marts.mart_goc_annual_summary(self._whole("mart_goc_aoc_quarterly"))

    @cached_property
    def mart_annual_aoc_detail(self) -> DataFrame:
        return marts.mart_annual_aoc_detail(self._whole("mart_goc_aoc_quarterly"))

    @cached_property
    def val_retro_no_double_recovery(self) -> DataFrame:
        return validate.val_retro_no_double_recovery(self._whole("int_retro_quarterly_movement"), self.params)

    @cached_property
    def val_summary(self) -> DataFrame:
        return validate.val_summary({n: self._whole(n) if n in DATED else self.model(n) for n in validate.VALIDATORS})

    def publish_next(self, *, tolerate: Iterable[str] = (), tests: list[quality.DataTest] | None = None) -> int:
        """Write the quarters, audit the whole ledger as it would stand, publish the next version; its number.

        LookupError if another version was published meanwhile, PublishRejected if the audit fails."""
        folder = self.store.new_folder()
        written = self.publish(f"{self.store.base}/{folder}", partition_by=DATED)
        models = self._entries(self.store, folder, written)
        for name, column, first in [*((n, "reporting_date", f"reporting_date={self.start}") for n in DATED),
                                    (BALANCES, "period", f"period={self.period}")]:
            # Old partitions first; quarters are four-digit years and numbers, so their names sort like themselves.
            kept = [{**f, "partitions": [p for p in f["partitions"] if p.startswith(f"{column}=") and p < first]}
                    for f in self.before["models"][name]["folders"]]
            models[name]["folders"] = [f for f in kept if f["partitions"]] + models[name]["folders"]
        draft = {"models": models}
        for name in Ledger.MODELS:
            self.__dict__[name] = self.store.table(draft, name)
        found = self.findings(tests)
        store.audited(found, tolerate)
        return self.store.commit(models, audit=found, expected=self.version,
                                 note={"rebuilt_from": str(self.start), "over": self.version})
