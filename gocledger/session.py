"""Session helpers: local session for tests/bench, checkpoint directory, lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_CKPT_KEY = "spark.checkpoint.dir"

#: Folder of this process's lineage-cut tables below ``spark.checkpoint.dir``/gocledger.
RUN = f"run-{uuid.uuid4().hex}"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "gocledger") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("GOCLEDGER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``; that value is used as is.
    Only a local-mode session (tests, bench) without the setting gets a fresh
    scratch folder of its own.
    """
    configured = spark.conf.get(_CKPT_KEY, None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        sc = None
    if not configured and sc is not None:
        configured = sc.getCheckpointDir() or sc.getConf().get(_CKPT_KEY, None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError(
                f"{_CKPT_KEY} is not set: a cluster run needs a shared checkpoint folder")
        configured = tempfile.mkdtemp(prefix="gocledger-ckpt-")
        spark.conf.set(_CKPT_KEY, configured)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def remove_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` through the cluster file system (Hadoop API);
    returns False when the session exposes no JVM (nothing is deleted then)."""
    try:
        jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    except Exception:  # noqa: BLE001
        return False
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(jsc.hadoopConfiguration()).delete(jpath, True))


class FileSystem:
    """The few calls on the cluster's file system that publishing needs (Hadoop API)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._gateway, self._jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def list(self, folder: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        at = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, path: str) -> bytes:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, path: str, data: bytes) -> None:
        stream = self._fs.create(self._path(path), False)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()

    def rename_if_absent(self, source: str, target: str) -> bool:
        """Atomic rename; False (and nothing done) if the target is there already."""
        from py4j.protocol import Py4JJavaError

        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        no_overwrite = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self._path(source), self._path(target), no_overwrite)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise

    def delete(self, path: str) -> bool:
        return bool(self._fs.delete(self._path(path), True))


def file_system(spark: SparkSession, path: str) -> FileSystem:
    return FileSystem(spark, path)


def run_folder(spark: SparkSession, run: str | None = None) -> str:
    """Where a run's lineage-cut tables lie (default: this process's run)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/gocledger/{run or RUN}"


def release_run(spark: SparkSession, run: str | None = None) -> bool:
    """Delete all lineage-cut tables of a run.  For the end of a job: results that were
    not stored elsewhere cannot be read afterwards."""
    return remove_path(spark, run_folder(spark, run))


@contextmanager
def own_run(spark: SparkSession) -> Iterator[None]:
    """A run of its own for what is done inside: its tables go at the end, those of the run around it stay."""
    global RUN
    outer, RUN = RUN, f"run-{uuid.uuid4().hex}"
    try:
        yield
    finally:
        release_run(spark)
        RUN = outer


def cut_lineage(df: DataFrame, name: str = "node", written: list[str] | None = None) -> DataFrame:
    """Materialise ``df`` reliably and cut its lineage.

    The rows are written once as parquet into the shared checkpoint folder and
    read back: one job (an eager ``checkpoint()`` of an unpersisted plan runs it
    twice), the result survives executor loss, and the re-read table carries
    real file-size statistics for Catalyst's join planning.
    """
    return cut_lineage_counted(df, name, written)[0]


def cut_lineage_observed(df: DataFrame, name: str, metrics: list, written: list[str] | None = None,
                         partition_by: tuple[str, ...] = ()) -> tuple[DataFrame, dict]:
    """``cut_lineage`` that also returns aggregates observed while writing; in folders by ``partition_by``."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/gocledger/{RUN}/{name}-{uuid.uuid4().hex}"
    if written is not None:
        written.append(path)
    obs = Observation(f"of_{name}_{uuid.uuid4().hex[:8]}")
    df.observe(obs, *metrics).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns), dict(obs.get)


def cut_lineage_counted(df: DataFrame, name: str = "node",
                        written: list[str] | None = None) -> tuple[DataFrame, int]:
    """``cut_lineage`` that also returns the row count, observed while writing
    (no second job to count).  The written path is appended to ``written``."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/gocledger/{RUN}/{name}-{uuid.uuid4().hex}"
    if written is not None:
        written.append(path)
    obs = Observation(f"rows_{name}_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), int(obs.get["n"])
