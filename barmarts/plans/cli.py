"""Command line for the scheduled jobs: ingest, build the models, run the data tests.

    python -m barmarts.plans.cli backfill    --landing DIR --table DIR [--provider P] [--batch-id B]
    python -m barmarts.plans.cli incremental --landing DIR --table DIR --symbols A,B,...
    python -m barmarts.plans.cli build       --bronze DIR --out DIR
    python -m barmarts.plans.cli test        --bronze DIR --marts DIR [--symbols A,B,...] [--providers P,...]

Each command runs in the session spark-submit provides (or a local one), and exits non-zero
when a gate or a data test fails, so a scheduler stops the downstream jobs.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import uuid

from pyspark.sql import SparkSession

from barmarts.operators.quality import GateError
from barmarts.operators.upsert import read_bronze
from barmarts.plans.pipeline import (assert_data_tests, data_tests, historical_load,
                                     incremental_load, materialise_marts, stored_marts)
from barmarts.schemas import DEFAULT_PROVIDER
from barmarts.session import DEFAULT_CONF
from barmarts.sources.landing import read_vendor_csv, universe_frame


def _csv_list(text: str | None) -> list[str] | None:
    return [x.strip() for x in text.split(",") if x.strip()] if text else None


def _session() -> SparkSession:
    """The session that spark-submit provides, with the library's defaults applied."""
    spark = SparkSession.builder.config(map=DEFAULT_CONF).getOrCreate()
    for key, value in DEFAULT_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="barmarts")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("backfill", "incremental"):
        p = sub.add_parser(name)
        p.add_argument("--landing", required=True)
        p.add_argument("--table", required=True)
        p.add_argument("--provider", default=DEFAULT_PROVIDER)
        p.add_argument("--batch-id", default=None)
        if name == "incremental":
            p.add_argument("--symbols", required=True)
    p = sub.add_parser("build")
    p.add_argument("--bronze", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("test")
    p.add_argument("--bronze", required=True)
    p.add_argument("--marts", required=True)
    p.add_argument("--symbols", default=None)
    p.add_argument("--providers", default=None)
    args = ap.parse_args(argv)

    spark = spark or _session()
    batch_id = getattr(args, "batch_id", None) or str(uuid.uuid4())
    stamp = dt.datetime.now(dt.timezone.utc).replace(microsecond=0, tzinfo=None).isoformat(sep=" ")
    try:
        if args.cmd == "backfill":
            rejected = historical_load(spark, read_vendor_csv(spark, args.landing), args.table,
                                       args.provider, batch_id, stamp)
            n = rejected.count()
            print(f"backfill {batch_id}: {n} rejected rows")
        elif args.cmd == "incremental":
            incremental_load(spark, read_vendor_csv(spark, args.landing), args.table,
                             universe_frame(spark, _csv_list(args.symbols)), args.provider, batch_id, stamp)
            print(f"incremental {batch_id}: merged")
        elif args.cmd == "build":
            written = materialise_marts(spark, read_bronze(spark, args.bronze), args.out)
            print("built: " + ", ".join(sorted(written)))
        else:
            report = data_tests(read_bronze(spark, args.bronze), stored_marts(spark, args.marts),
                                _csv_list(args.symbols), _csv_list(args.providers))
            assert_data_tests(report)
            print("data tests passed")
    except GateError as e:
        print(f"refused: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
