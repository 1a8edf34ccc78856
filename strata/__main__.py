"""Command line for scheduled runs (e.g. ``spark-submit -m strata run ...``).

    python -m strata run --landing L --root R [--dedup-mode merge|state] [--gold-mode complete|update]
    python -m strata audit --root R [--out PATH]
    python -m strata history --root R --table silver.taxi
    python -m strata restore --root R --table bronze.drivers --version 3
    python -m strata optimize --root R --table gold.enriched_trips [--cluster-by COL] [--zorder]

The session comes from the submitting environment (master, checkpoint dir,
sizes); only the recommended runtime settings that are unset get applied.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata")
    sub = p.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="run the ten flows once (availableNow)")
    run.add_argument("--landing", required=True)
    run.add_argument("--root", required=True)
    run.add_argument("--users-format", default="parquet")
    run.add_argument("--dedup-mode", choices=["merge", "state"], default="merge")
    run.add_argument("--gold-mode", choices=["complete", "update"], default="complete")
    run.add_argument("--max-files-per-trigger", type=int, default=10_000)
    run.add_argument("--sequential", action="store_true", help="do not run independent flows concurrently")
    audit = sub.add_parser("audit", help="audit the ten tables, print the summary, write the report")
    audit.add_argument("--root", required=True)
    audit.add_argument("--out")
    helps = {"history": "print a table's versions", "restore": "publish an old version as the newest",
             "optimize": "bin-pack small files, or cluster by a column"}
    for name in ("history", "restore", "optimize"):
        sp = sub.add_parser(name, help=helps[name])
        sp.add_argument("--root", required=True)
        sp.add_argument("--table", required=True, help="layer.table")
        if name == "restore":
            sp.add_argument("--version", type=int, required=True)
        if name == "optimize":
            sp.add_argument("--cluster-by")
            sp.add_argument("--zorder", action="store_true")
            sp.add_argument("--rows-per-file", type=int, default=1_000_000, help="with --cluster-by")
            sp.add_argument("--target-mb", type=int, default=128, help="size of a packed file")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    from .session import apply_recommended_conf
    from .tables.versioned import Lakehouse

    spark = spark or SparkSession.builder.appName(f"strata-{args.cmd}").getOrCreate()
    apply_recommended_conf(spark)
    house = Lakehouse(spark, args.root)

    if args.cmd == "run":
        from .plans.pipeline import Landing, run_medallion

        counts = run_medallion(
            spark, Landing(args.landing, users_fmt=args.users_format), house, parallel=not args.sequential,
            max_files_per_trigger=args.max_files_per_trigger,
            dedup_mode=args.dedup_mode, gold_mode=args.gold_mode)
        print(json.dumps({"rule_failures": counts}))
    elif args.cmd == "audit":
        from .audit import audit_tables, report, save_report
        from .plans.pipeline import TABLES

        doc = report(spark, audit_tables(spark, house, TABLES), "lakehouse", "cli", args.root)
        if args.out:
            save_report(doc, args.out)
        print(json.dumps(doc.select("summary").first()["summary"].asDict()))
    else:
        layer, name = args.table.split(".", 1)
        t = house.table(layer, name)
        if args.cmd == "restore":
            print(json.dumps({"version": t.restore(args.version)}))
        elif args.cmd == "optimize":
            v = (t.cluster(args.cluster_by, args.rows_per_file, zorder=args.zorder) if args.cluster_by
                 else t.compact(args.target_mb << 20))
            print(json.dumps({"version": v}))
        for r in t.history().select("version", "timestamp", "operation", "operationParameters").collect():
            print(json.dumps(r.asDict(recursive=True)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
