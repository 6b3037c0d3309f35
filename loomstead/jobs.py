"""Jobs for ``spark-submit``: dump, restore and ingest.

    jobs.py backup ROOT [OUT]
    jobs.py restore DUMP ROOT [--apply] [--table T]
    jobs.py ingest SOURCE STORE [--glob G] [--wing W] [--batch N] [--limit N] [--dim D] [--status]

ROOT holds one folder of snapshots per table. A restore without ``--apply`` only compares counts.
"""

import argparse
import time
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from loomstead.operators import reports
from loomstead.operators.embedding import HashedTextEmbedder
from loomstead.schemas import COLLECTION_SCHEMA, DEFAULT_DIM, ENTITY_SCHEMA, TRIPLE_SCHEMA
from loomstead.session import tune
from loomstead.sources import dumps, tables
from loomstead.streaming import ingest

FACT_SCHEMAS = {"entities": ENTITY_SCHEMA, "triples": TRIPLE_SCHEMA}


def schema_of(table: str):
    return FACT_SCHEMAS.get(table, COLLECTION_SCHEMA)


def current_tables(spark, root):
    return {
        name: tables.read_snapshot(spark, f"{root}/{name}", schema_of(name))[1]
        for name in tables.table_names(spark, root)
    }


def backup(spark, args):
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d-%H%M%SZ")
    out = args.out or f"{args.root.rstrip('/')}-backup-{stamp}"
    dumps.export_tables(current_tables(spark, args.root), out, stamp)
    dumps.read_manifest(spark, out).show(truncate=False)
    print(f"written to {out}")


def restore(spark, args):
    listed = dumps.read_manifest(spark, args.dump)
    dumps.dry_run(listed, current_tables(spark, args.root), args.table).show(truncate=False)
    if not args.apply:
        print("dry run; use --apply to load")
        return
    names = [r["table"] for r in listed.select("table").collect()]
    schemas = {name: schema_of(name) for name in names}
    roots = {name: f"{args.root}/{name}" for name in names}
    for name, version in dumps.restore(spark, args.dump, schemas, roots, args.table).items():
        print(f"{name}: snapshot {version}")


def run_ingest(spark, args):
    files, seconds = 0, 0.0
    if not args.status:
        before = ingest.progress(spark, args.source, args.store, args.glob).filter("status = 'done'").count()
        embedder = HashedTextEmbedder(args.dim)
        start = time.monotonic()
        ingest.ingest(
            spark, args.source, args.store, args.dim, embedder, args.glob, args.batch, args.limit,
            defaults={"wing": args.wing} if args.wing else None,
        )
        seconds = time.monotonic() - start
    progress = ingest.progress(spark, args.source, args.store, args.glob)
    if not args.status:
        files = progress.filter("status = 'done'").count() - before
    reports.ingest_status(progress, files, seconds).show()


def main(argv=None):
    parser = argparse.ArgumentParser(prog="jobs.py")
    commands = parser.add_subparsers(required=True)
    one = commands.add_parser("backup")
    one.add_argument("root")
    one.add_argument("out", nargs="?")
    one.set_defaults(job=backup)
    two = commands.add_parser("restore")
    two.add_argument("dump")
    two.add_argument("root")
    two.add_argument("--apply", action="store_true")
    two.add_argument("--table")
    two.set_defaults(job=restore)
    three = commands.add_parser("ingest")
    three.add_argument("source")
    three.add_argument("store")
    three.add_argument("--glob", default="*.jsonl")
    three.add_argument("--wing")
    three.add_argument("--batch", type=int, default=50)
    three.add_argument("--limit", type=int, default=0)
    three.add_argument("--dim", type=int, default=DEFAULT_DIM)
    three.add_argument("--status", action="store_true")
    three.set_defaults(job=run_ingest)
    args = parser.parse_args(argv)
    args.job(tune(SparkSession.builder.appName("loomstead").getOrCreate()), args)


if __name__ == "__main__":
    main()
