"""Write, audit, publish: readers see whole versions or nothing."""

import os
import signal
import subprocess
import sys
import tempfile
import textwrap

import pytest

from gocledger.operators import quality
from gocledger.plans.pipeline import Ledger
from gocledger.sources import sinks, store

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def sorted_rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def published(spark):
    base = tempfile.mkdtemp(prefix="gocledger-store-")
    led = Ledger.golden(spark)
    assert led.publish_audited(base, release_scratch=True) == 1
    return base


def test_version_holds_every_model(spark, published, golden):
    st = store.VersionedStore(spark, published)
    assert st.versions() == [1]
    manifest = st.manifest()
    assert set(manifest["models"]) == set(Ledger.MODELS) and not any(manifest["audit"].values())
    for name in ("int_treaty_bs_state", "mart_pnl_quarterly", "val_summary", "val_bs_invariants"):
        got = st.read(name)
        assert got.columns == golden.model(name).columns and sorted_rows(got) == sorted_rows(golden.model(name)), name
    dates = {f for e in manifest["models"]["int_treaty_bs_state"]["folders"] for f in e["partitions"]}
    assert "reporting_date=2026-06-30" in dates


def test_failed_publish_leaves_the_old_version(spark, published, monkeypatch):
    st = store.VersionedStore(spark, published)
    before, write = sorted_rows(st.read("mart_pnl_quarterly")), sinks.write_table

    def breaks(df, path, **kw):
        if "int_retro_bs_state" in path:
            raise OSError("disk gone")
        write(df, path, **kw)

    monkeypatch.setattr(sinks, "write_table", breaks)
    with pytest.raises(OSError):
        Ledger.golden(spark).publish_audited(published)
    assert st.versions() == [1] and sorted_rows(st.read("mart_pnl_quarterly")) == before
    assert len(os.listdir(os.path.join(published, "data"))) >= 2           # the abandoned folder, unseen


def test_audit_rejects(spark, published):
    st = store.VersionedStore(spark, published)
    strict = [quality.DataTest("int_treaty_bs_state", "row_count_between", values=(10 ** 6, None))]
    with pytest.raises(store.PublishRejected) as e:
        Ledger.golden(spark).publish_audited(published, tests=strict)
    assert e.value.findings == {"int_treaty_bs_state. row_count_between": 1} and st.versions() == [1]
    assert not [n for n in os.listdir(os.path.join(published, "_versions")) if n.startswith(".draft")]


def test_killed_publish_leaves_the_old_version(spark, published):
    """A process killed in the middle of its writes."""
    st = store.VersionedStore(spark, published)
    before, folders = sorted_rows(st.read("int_treaty_bs_state")), set(os.listdir(os.path.join(published, "data")))
    code = textwrap.dedent(f"""
        import os, signal, sys
        sys.path.insert(0, {ROOT!r})
        from gocledger.session import local_session
        from gocledger.plans.pipeline import Ledger
        from gocledger.sources import sinks
        write = sinks.write_table
        def dies(df, path, **kw):
            write(df, path, **kw)
            if "int_treaty_bs_state" in path:
                os.kill(os.getpid(), signal.SIGKILL)
        sinks.write_table = dies
        Ledger.golden(local_session(cpus=2, shuffle_partitions=2)).publish_audited({published!r})
    """)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=300)
    assert done.returncode == -signal.SIGKILL, done.stderr[-2000:]
    left = set(os.listdir(os.path.join(published, "data"))) - folders
    assert len(left) == 1 and os.path.isdir(os.path.join(published, "data", left.pop(), "int", "int_treaty_bs_state"))
    assert st.versions() == [1] and sorted_rows(st.read("int_treaty_bs_state")) == before


def test_open_reader_keeps_its_version_and_vacuum(spark, published):
    st = store.VersionedStore(spark, published)
    reader = st.read("mart_pnl_quarterly")                                 # lazily opened on version 1
    old = sorted_rows(reader)
    led = Ledger.golden(spark)
    led.publish_audited(published)
    assert st.versions()[-1] == 2 and sorted_rows(reader) == old
    gone = st.vacuum(keep=1)
    assert st.versions() == [2] and gone and len(os.listdir(os.path.join(published, "data"))) == 1
    assert sorted_rows(st.read("mart_pnl_quarterly")) == old
    with pytest.raises(LookupError):
        st.read("mart_pnl_quarterly", version=1)


def test_commits_take_the_next_free_number(spark, tmp_path):
    st = store.VersionedStore(spark, str(tmp_path / "s"))
    with pytest.raises(LookupError):
        st.manifest()
    assert st.commit({}) == 1 and st.commit({}) == 2 and st.commit({}, expected=2) == 3
    with pytest.raises(LookupError):
        st.commit({}, expected=2)
    # two publishers after the same version: the second rename finds the number taken
    draft = f"{st.base}/_versions/.draft-x"
    st.fs.write(draft, b"{}")
    assert not st.fs.rename_if_absent(draft, f"{st.base}/_versions/{3:012d}.json")
    assert st.fs.rename_if_absent(draft, f"{st.base}/_versions/{4:012d}.json") and st.versions() == [1, 2, 3, 4]


def test_empty_partitioned_table_reads_back(spark, tmp_path):
    st = store.VersionedStore(spark, str(tmp_path / "s"))
    df = spark.createDataFrame([], "a int, reporting_date date")
    n = st.commit({"t": st.entry(df, [{"path": "data/none/int/t", "partitions": []}])})
    assert st.read("t", n).collect() == [] and st.read("t").columns == ["a", "reporting_date"]
