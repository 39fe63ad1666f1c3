"""Command line: build every model, or run the checks.

    python -m gocledger run  --sf-dir /root/testdata/sf0.01 --out /shared/ledger
    python -m gocledger publish --sf-dir /root/testdata/sf0.01 --out /shared/versions
    python -m gocledger rebuild --sf-dir /root/testdata/sf0.01 --out /shared/versions --first 2001-07-01
    python -m gocledger test --sf-dir /root/testdata/sf0.01

``run`` writes all models layer by layer (stg / int / val / mart) as parquet
tables, in place.  ``publish`` writes them as the next version of a store that
others read meanwhile: the version appears only when the validators and data
tests of its written tables pass (``--tolerate`` names those that may fail).  ``rebuild`` makes the quarters from a date
on again and publishes them with the older quarters of the last version.  ``test`` prints the validator summary and every failing declared data
test, and exits non-zero when anything fails.  Both use the active cluster
session when there is one (``spark.checkpoint.dir`` must then be set) and a
local session otherwise.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from gocledger.session import local_session
    return local_session()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="gocledger")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="publish every model")
    run.add_argument("--sf-dir", required=True)
    run.add_argument("--out", required=True)
    pub = sub.add_parser("publish", help="write, audit, then publish the next version")
    pub.add_argument("--sf-dir", required=True)
    pub.add_argument("--out", required=True)
    pub.add_argument("--tolerate", action="append", default=[], help="a validator or data test that may fail")
    again = sub.add_parser("rebuild", help="publish the next version with the quarters from a date on made again")
    again.add_argument("--sf-dir", required=True)
    again.add_argument("--out", required=True)
    again.add_argument("--first", required=True, help="a date in the first quarter to make again, YYYY-MM-DD")
    again.add_argument("--tolerate", action="append", default=[], help="a validator or data test that may fail")
    test = sub.add_parser("test", help="validators and declared data tests")
    test.add_argument("--sf-dir", required=True)
    args = parser.parse_args(argv)

    from gocledger.plans.pipeline import Ledger
    from gocledger.session import own_run

    spark = _session()
    with own_run(spark):
        return _command(args, spark, Ledger)


def _command(args: argparse.Namespace, spark: SparkSession, Ledger: type) -> int:
    if args.command == "run":
        led = Ledger.from_driver(spark, args.sf_dir, materialize_raw=True)
        for name, path in led.publish(args.out, release_scratch=True).items():
            print(f"{name}\t{path}")
        return 0

    if args.command in ("publish", "rebuild"):
        from gocledger.plans.rebuild import QuarterRebuild
        from gocledger.sources import binding
        from gocledger.sources.store import PublishRejected, VersionedStore

        try:
            if args.command == "publish":
                led = Ledger.from_driver(spark, args.sf_dir, materialize_raw=True)
                made = led.publish_audited(args.out, tolerate=args.tolerate, release_scratch=True)
            else:
                led = QuarterRebuild(spark, VersionedStore(spark, args.out), binding.bind(spark, args.sf_dir),
                                     dt.date.fromisoformat(args.first))
                made = led.publish_next(tolerate=args.tolerate)
            print(f"version {made}")
            return 0
        except PublishRejected as e:
            for name, n in sorted(e.findings.items()):
                print(f"FAIL {name}: {n}")
            return 1

    led = Ledger.from_driver(spark, args.sf_dir, materialize_raw=True)
    led.materialize_all()
    summary = led.val_summary.collect()
    for r in sorted(summary):
        print(f"{r.validation:34s} {r.fail_count}")
    failing = led.data_tests().filter(F.col("failures") > 0).collect()
    for r in sorted(failing):
        print(f"FAIL {r.model}.{r.column_name} {r.test_name}: {r.failures}")
    print(f"data tests failing: {len(failing)}")
    return 1 if failing or any(r.fail_count for r in summary) else 0


if __name__ == "__main__":
    sys.exit(main())
