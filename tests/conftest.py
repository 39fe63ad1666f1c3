from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark():
    from gocledger.session import ensure_checkpoint_dir, local_session
    warehouse = tempfile.mkdtemp(prefix="gocledger-warehouse-")
    SparkSession.builder.config("spark.sql.warehouse.dir", warehouse)
    s = local_session(cpus="*", shuffle_partitions=8, app="gocledger-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def golden(spark):
    """The golden-scenario ledger with every model written once (publish path)."""
    from gocledger.plans.pipeline import Ledger
    led = Ledger.golden(spark)
    led.materialize_all()
    return led
