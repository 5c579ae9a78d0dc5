"""Ingestion steps for spark-submit: ``spark-submit brontide/jobs.py STEP --table NAME ...``.

Each step prints a line with a fixed marker when it is done and fails with a non-zero exit code
when a gate does not pass.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a file
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from brontide.operators.quality import ForeignKey
from brontide.plans import ingest as I
from brontide.session import build_session
from brontide.sources import artifacts, relational, tables


def _keys(text: str) -> tuple[str, ...]:
    return tuple(k.strip() for k in text.split(",") if k.strip())


def _foreign_key(text: str) -> ForeignKey:
    name, target = text.split("=", 1)
    table, ref = target.rsplit(".", 1)
    return ForeignKey(name, table, ref)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="jobs.py")
    steps = root.add_subparsers(dest="step", required=True)

    def step(name: str, *folders: str) -> argparse.ArgumentParser:
        sub = steps.add_parser(name)
        sub.add_argument("--table", required=True)
        for folder in folders:
            sub.add_argument(f"--{folder}", required=True)
        return sub

    def with_source(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--jdbc-url", help="relational source")
        sub.add_argument("--parquet", help="Parquet source instead")
        sub.add_argument("--partition-column")
        sub.add_argument("--lower-bound")
        sub.add_argument("--upper-bound")
        sub.add_argument("--num-partitions", type=int)
        sub.add_argument("--primary-keys", type=_keys, default=(), help="in key order, by comma")
        sub.add_argument("--foreign-key", type=_foreign_key, action="append", default=[],
                         metavar="COLUMN=TABLE.COLUMN")

    def with_target(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--format", help="format of the target table; Delta where configured")

    with_source(step("export", "csv-dir", "metadata-dir"))
    step("check-csv", "csv-dir")
    cleanse = step("cleanse", "csv-dir", "cleansed-dir", "metadata-dir")
    with_target(step("load", "cleansed-dir", "target-base"))
    validate = step("validate", "target-base")
    with_target(validate)
    validate.add_argument("--min-rows", type=int, default=0)
    ingest = step("ingest", "csv-dir", "cleansed-dir", "metadata-dir", "target-base")
    with_source(ingest)
    with_target(ingest)
    ingest.add_argument("--min-rows", type=int, default=0)
    for sub in (cleanse, ingest):
        sub.add_argument("--infer-types", action="store_true",
                         help="from the text, also where the metadata has them")
    return root


def _source(spark, args):
    if args.parquet:
        return tables.scan_parquet(spark, args.parquet)
    return relational.scan_jdbc(
        spark, args.jdbc_url, args.table, partition_column=args.partition_column,
        lower_bound=args.lower_bound, upper_bound=args.upper_bound,
        num_partitions=args.num_partitions)


def run(spark, args: argparse.Namespace) -> None:
    table = args.table
    folders = I.Folders(*(getattr(args, name, "") or "" for name in (
        "csv_dir", "cleansed_dir", "metadata_dir", "target_base")))

    def spec() -> I.TableSpec:
        return I.TableSpec(table, args.primary_keys, tuple(args.foreign_key),
                           getattr(args, "min_rows", 0))

    if args.step == "export":
        n = I.export_table(_source(spark, args), spec(), folders)
        print(f"[EXPORT_OK] table={table} rows={n} csv={folders.csv_path(table)}")
    elif args.step == "check-csv":
        artifacts.require_artifact(spark, folders.csv_path(table))
        print(f"[VALIDATE_CSV_OK] {folders.csv_path(table)}")
    elif args.step == "cleanse":
        report = I.cleanse_table(spark, table, folders, args.infer_types).first()
        print(f"[DQ_OK] table={table} source_rows={report['source_rows']} "
              f"cleansed_rows={report['cleansed_rows']}")
    elif args.step == "load":
        n = I.load_table(spark, table, folders, args.format)
        print(f"[LOAD_OK] table={table} rows={n}")
    elif args.step == "validate":
        n = I.validate_table(spark, table, folders, args.min_rows, args.format)
        print(f"[VALIDATE_OK] table={table} rows={n}")
        df = tables.scan_table(spark, folders.target, table, args.format)
        df.printSchema()
        df.show(10, truncate=False)  # any ten rows: an order would read the whole table
    else:
        report = I.ingest_table(_source(spark, args), spec(), folders, fmt=args.format,
                                infer_types=args.infer_types).first()
        print(f"[LOAD_OK] table={table} rows={report['target_rows']}")


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    run(build_session(f"{args.step}-{args.table}"), args)


if __name__ == "__main__":
    main()
