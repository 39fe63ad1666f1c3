"""A published ledger as versions: write, audit, then publish.

Layout below ``base``:

* ``data/<run>/<layer>/<model>`` — tables of one publish, never changed afterwards;
* ``_versions/<n>.json`` — version n: for every model its table folders, columns and
  row count, and what the audit found.

A publish writes all its tables into a new ``data`` folder, audits the *written*
tables, and only then commits: the finished version file is renamed to the next
free number, which fails if another publish took it (then the number after it is
tried).  Until that rename no reader can see any of its tables; readers that have
opened an older version keep reading that version's files, which stay until
:meth:`VersionedStore.vacuum`.  A publish that dies at any point leaves the
last version as it was, and at most an unreferenced ``data`` folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gocledger.session import file_system, remove_path

_VERSIONS = "_versions"


class PublishRejected(Exception):
    """The audit found failures in tables that a publish had written; no version was made."""

    def __init__(self, findings: Mapping[str, int]) -> None:
        super().__init__("not published: " + ", ".join(f"{k} ({v})" for k, v in sorted(findings.items())))
        self.findings = dict(findings)


class VersionedStore:
    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self.fs = file_system(spark, self.base)

    # -- readers -----------------------------------------------------------------
    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        names = self.fs.list(f"{self.base}/{_VERSIONS}")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """What a version (default: the last) consists of."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise LookupError(f"no version {version if known and version is not None else ''} under {self.base}")
        return json.loads(self.fs.read(f"{self.base}/{_VERSIONS}/{(known[-1] if version is None else version):012d}.json"))

    def read(self, model: str, version: int | None = None) -> DataFrame:
        """A model's table as of a version.  Partitions of other publishes are read beside the version's own."""
        return self.table(self.manifest(version), model)

    def table(self, manifest: dict, model: str) -> DataFrame:
        entry = manifest["models"][model]
        schema = T.StructType.fromJson(entry["schema"])
        parts: DataFrame | None = None
        for folder in entry["folders"]:
            path = f"{self.base}/{folder['path']}"
            reader = self.spark.read.schema(schema)
            if folder.get("partitions") is None:
                one = reader.parquet(path)
            else:
                if not folder["partitions"]:
                    continue
                one = reader.option("basePath", path).parquet(*[f"{path}/{p}" for p in folder["partitions"]])
            one = one.select(*schema.names)
            parts = one if parts is None else parts.unionByName(one)
        return self.spark.createDataFrame([], schema) if parts is None else parts

    # -- writers -----------------------------------------------------------------
    def new_folder(self) -> str:
        """A fresh folder for one publish, relative to ``base``."""
        return f"data/{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"

    def entry(self, df: DataFrame, folders: Sequence[dict]) -> dict:
        return {"schema": json.loads(df.schema.json()), "folders": list(folders)}

    def partitions(self, folder: str) -> list[str]:
        """``column=value`` folders of a partitioned table."""
        return sorted(n for n in self.fs.list(f"{self.base}/{folder}") if "=" in n)

    def commit(self, models: Mapping[str, dict], *, audit: Mapping[str, int] | None = None, note: Mapping | None = None,
               expected: int | None = None) -> int:
        """Publish a set of written tables as the next version; its number.

        ``expected``: the version that the tables were derived from (0: none); if it is no
        longer the last one, LookupError and nothing is published."""
        made = {"models": dict(models), "audit": dict(audit or {}), "note": dict(note or {}),
                "committed": datetime.now(timezone.utc).isoformat()}
        draft = f"{self.base}/{_VERSIONS}/.draft-{uuid.uuid4().hex}"
        self.fs.write(draft, json.dumps(made, sort_keys=True).encode())
        try:
            while True:
                last = (self.versions() or [0])[-1]
                if expected is not None and last != expected:
                    raise LookupError(f"version {expected} was to be followed, but {last} is the last")
                if self.fs.rename_if_absent(draft, f"{self.base}/{_VERSIONS}/{last + 1:012d}.json"):
                    return last + 1
        finally:
            self.fs.delete(draft)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Forget all but the last ``keep`` versions, and delete the data folders that no version
        left refers to (abandoned publishes among them; none may be running).  Returns what was deleted."""
        known = self.versions()
        for old in known[:-keep] if keep else known:
            self.fs.delete(f"{self.base}/{_VERSIONS}/{old:012d}.json")
        used = {"/".join(f["path"].split("/")[:2]) for v in self.versions()
                for e in self.manifest(v)["models"].values() for f in e["folders"]}
        gone = [f"data/{n}" for n in self.fs.list(f"{self.base}/data") if f"data/{n}" not in used]
        for folder in gone:
            remove_path(self.spark, f"{self.base}/{folder}")
        return gone


def audited(findings: Mapping[str, int], tolerate: Iterable[str] = ()) -> None:
    """PublishRejected if anything was found that is not to be tolerated."""
    allowed = set(tolerate)
    bad = {k: v for k, v in findings.items() if v and k not in allowed}
    if bad:
        raise PublishRejected(bad)
