"""Command line for the three jobs.

    python -m tierload.cli crawl  --root ROOT [--prefix P] [--database DB] [--inventory T] [--dry-run]
    python -m tierload.cli silver --config silver.json [--bronze-database DB] [--dataset=NAME]
                                  [--dry-run] [--rebuild] [--confirm-append-only] [--keep-versions N]
    python -m tierload.cli gold   --config mappings.json [--silver-prefix silver_] [--table NAME]
                                  [--jdbc-url URL [--run-id ID]]
                                  [--keep-versions N]

Prints the summary; exits with status 1 when any dataset, table or partition failed.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F


def _args(argv):
    p = argparse.ArgumentParser(prog="tierload")
    sub = p.add_subparsers(dest="job", required=True)
    c = sub.add_parser("crawl")
    c.add_argument("--root", required=True)
    c.add_argument("--prefix", default="")
    c.add_argument("--database")
    c.add_argument("--inventory")
    c.add_argument("--dry-run", action="store_true")
    s = sub.add_parser("silver")
    s.add_argument("--config", required=True)
    s.add_argument("--bronze-database", default="bronze")
    s.add_argument("--silver-prefix", default="silver_")
    s.add_argument("--dataset")
    s.add_argument("--dry-run", action="store_true")
    s.add_argument("--rebuild", action="store_true")
    s.add_argument("--confirm-append-only", action="store_true")
    s.add_argument("--buckets", type=int)
    s.add_argument("--keep-versions", type=int)
    g = sub.add_parser("gold")
    g.add_argument("--config", required=True)
    g.add_argument("--silver-prefix", default="silver_")
    g.add_argument("--gold-prefix", default="gold_")
    g.add_argument("--table")
    g.add_argument("--jdbc-url")
    g.add_argument("--run-id")
    g.add_argument("--buckets", type=int)
    g.add_argument("--keep-versions", type=int)
    return p.parse_args(argv)


def run(spark, argv) -> int:
    """Run one job; returns the process exit status."""
    a = _args(argv)
    if a.job == "crawl":
        from .plans.crawl import crawl
        summary = crawl(spark, a.root, a.prefix, a.database, plan_only=a.dry_run,
                        inventory=a.inventory)
        summary.show(truncate=False)
        failed = summary.agg(F.sum("partitions_failed")).first()[0] or 0
        if failed:
            print(f"{failed} partitions could not be registered", file=sys.stderr)
        return 1 if failed else 0
    with open(a.config) as fh:
        doc = json.load(fh)
    if a.job == "silver":
        from .config import silver_config_from_json
        from .plans.silver import any_failed, load_silver
        validation, datasets = silver_config_from_json(doc)
        summary = load_silver(spark, lambda name: spark.table(f"{a.bronze_database}.{name}"),
                              datasets, validation, plan_only=a.dry_run, rebuild=a.rebuild,
                              confirm=a.confirm_append_only, table_prefix=a.silver_prefix,
                              buckets=a.buckets, only=a.dataset, keep_versions=a.keep_versions)
        summary.show(truncate=False)
        return 1 if any_failed(summary) else 0
    from .config import gold_config_from_json
    from .plans.gold import load_gold
    settings, tables = gold_config_from_json(doc)
    jdbc = None
    if a.jdbc_url:
        from .sources.jdbc import JdbcTarget
        jdbc = JdbcTarget(spark, a.jdbc_url, schema=settings.schema)
    summary = load_gold(spark, lambda name: spark.table(f"{a.silver_prefix}{name}"), tables,
                        settings, table_prefix=a.gold_prefix, buckets=a.buckets, jdbc=jdbc, run_id=a.run_id,
                        only=a.table, keep_versions=a.keep_versions)
    summary.show(truncate=False)
    return 1 if summary.where(F.col("status") != "OK").limit(1).count() else 0


def main(argv=None) -> int:
    from .session import build_session
    spark = build_session()
    return run(spark, sys.argv[1:] if argv is None else argv)


if __name__ == "__main__":
    sys.exit(main())
