"""Command line: run the three-layer job, or an upkeep step, on a warehouse root.

    spark-submit job.py run --source s3a://raw/tpch/ --root s3a://lake/wh --format text
    python -m strata compact --root /lake/wh --layer silver --table lineitem --partition-by ship_year
    python -m strata copy --root /lake/wh --to /backup/wh

The session comes from ``spark-submit`` / the environment (``getOrCreate``);
nothing here picks a master or a local folder.  Reports are printed whole, one
JSON line for each row.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata")
    sub = p.add_subparsers(dest="command", required=True)

    run = sub.add_parser("run", help="raw -> bronze -> silver -> gold")
    run.add_argument("--source", required=True)
    run.add_argument("--root", required=True)
    run.add_argument("--format", choices=["text", "parquet"], default="text")
    run.add_argument("--no-header", action="store_true")
    run.add_argument("--sep", default="|")
    run.add_argument("--suffix", default=".csv", help="raw file suffix, e.g. .tbl")
    run.add_argument("--register", action="store_true",
                     help="register bronze/silver/gold tables in the catalog")
    run.add_argument("--bronze-tasks", type=int, help="deal raw rows out to so many tasks")

    compact = sub.add_parser("compact", help="pack a table's small files into larger ones")
    for name in ("root", "layer", "table"):
        compact.add_argument(f"--{name}", required=True)
    compact.add_argument("--partition-by")

    copy = sub.add_parser("copy", help="copy every table to another root and compare")
    copy.add_argument("--root", required=True)
    copy.add_argument("--to", required=True)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"strata-{args.command}").getOrCreate()
    if args.command == "run":
        from strata.plans.layers import LayerJob
        job = LayerJob(source=args.source, root=args.root, source_format=args.format,
                       header=not args.no_header, sep=args.sep, suffix=args.suffix,
                       register=args.register, bronze_tasks=args.bronze_tasks)
        for row in job.run(spark).stored:
            print(json.dumps(row.asDict()))
    elif args.command == "compact":
        from strata.sinks import tables, upkeep
        path = tables.current_path(spark, args.root, args.layer, args.table)
        for packed in upkeep.compact(spark, path, args.partition_by):
            print(json.dumps(asdict(packed)))
    elif args.command == "copy":
        from strata.schemas import PARTITION_COLUMNS
        from strata.sinks import upkeep
        for row in upkeep.copy_tables(spark, args.root, args.to, PARTITION_COLUMNS).toLocalIterator():
            print(json.dumps(row.asDict()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
