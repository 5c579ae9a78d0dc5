"""Lakehouse tables: Delta where the session has it, else Parquet snapshots.

A snapshot table is a folder ``{base}/{table}`` with one sub-folder per written snapshot and a
``published`` log of small JSON files, one per publication. Readers take the latest logged
snapshot. So a writer can fill and check a snapshot before anybody sees it, a failed run
publishes nothing, and a running reader keeps the files it started with.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from brontide.sources import commits, levels
from brontide.sources.files import delete_path, list_names, make_folder, path_exists, read_text


def default_format(spark: SparkSession) -> str:
    return "delta" if "io.delta" in (spark.conf.get("spark.sql.extensions", "") or "") else "parquet"


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table.lower()}"


@dataclass(frozen=True)
class Snapshot:
    """A written but not yet published snapshot."""

    root: str
    name: str
    n_rows: int

    @property
    def path(self) -> str:
        return f"{self.root}/snapshots/{self.name}"


def write_counted(df: DataFrame, save) -> int:
    """Run ``save(df)`` and return the number of rows written.

    The rows are observed directly below the sink. There a retried task is counted once; ahead of
    a shuffle an observation could count the rows of a re-run map task twice.
    """
    observation = Observation()
    save(df.observe(observation, F.count(F.lit(1)).alias("n")))
    return observation.get["n"]


def stage_snapshot(df: DataFrame, base: str, table: str, keys: tuple[str, ...] = ()) -> Snapshot:
    """With ``keys`` rows are filed in ranges of these, each with a Bloom filter per row group, so that a lookup opens the few row
    groups that may hold its key: by their bounds for the first key, by the filters for the others."""
    root, name = table_path(base, table), uuid.uuid4().hex
    filed = levels.sorted_by(df, *keys) if keys else df
    n_rows = write_counted(filed, lambda d: d.write.options(**levels.key_filters(*keys)).parquet(f"{root}/snapshots/{name}"))
    return Snapshot(root, name, n_rows)


def _latest(spark: SparkSession, root: str) -> dict | None:
    return commits.last(spark, f"{root}/published")[1]


def publish_snapshot(spark: SparkSession, snapshot: Snapshot, keep: int | None = None) -> int:
    """Make a staged snapshot the current one; returns its version. Of several writers each gets a version of its own.

    With ``keep`` only the last so many publications stay listed and only their snapshots stay; a
    reader that began before those loses its files.
    """
    row = {"snapshot": snapshot.name, "n_rows": snapshot.n_rows, "published_at": datetime.now(timezone.utc).isoformat()}
    make_folder(spark, f"{snapshot.root}/published")
    version = commits.commit(spark, f"{snapshot.root}/published", lambda n: json.dumps({"version": n, **row}))
    if keep is not None:
        _prune(spark, snapshot.root, keep)
    return version


def _prune(spark: SparkSession, root: str, keep: int) -> None:
    # At most the publications since the last call and those kept then.
    found = commits.versions(spark, f"{root}/published")
    rows = [json.loads(read_text(spark, f"{root}/published/{name}")) for _, name in found]
    kept = {r["snapshot"] for r in rows[-keep:]}
    for _, name in found[:-keep]:
        delete_path(spark, f"{root}/published/{name}")
    # A snapshot that is staged but not published has no row; it is left to its writer.
    for gone in {r["snapshot"] for r in rows} - kept:
        delete_path(spark, f"{root}/snapshots/{gone}")


def scan_table(spark: SparkSession, base: str, table: str, fmt: str | None = None) -> DataFrame:
    """Current content of the table."""
    fmt, root = fmt or default_format(spark), table_path(base, table)
    if fmt != "parquet":
        return spark.read.format(fmt).load(root)
    latest = _latest(spark, root)
    if latest is None:
        raise FileNotFoundError(f"no published snapshot: {root}")
    return scan_parquet(spark, f"{root}/snapshots/{latest['snapshot']}")


def table_exists(spark: SparkSession, base: str, table: str, fmt: str | None = None) -> bool:
    fmt, root = fmt or default_format(spark), table_path(base, table)
    return path_exists(spark, root) if fmt != "parquet" else _latest(spark, root) is not None


def write_table(df: DataFrame, base: str, table: str, fmt: str | None = None, keep: int | None = None, keys: tuple[str, ...] = ()) -> int:
    """Replace the table's content, all or nothing; returns the rows written. For ``keep`` see ``publish_snapshot``, for ``keys``, the
    columns that rows are looked up by, ``stage_snapshot``; Delta tables are filed as they come."""
    spark = df.sparkSession
    fmt = fmt or default_format(spark)
    if fmt != "parquet":
        target = table_path(base, table)
        return write_counted(df, lambda d: d.write.format(fmt).mode("overwrite").save(target))
    snapshot = stage_snapshot(df, base, table, keys)
    publish_snapshot(spark, snapshot, keep)
    return snapshot.n_rows


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> int:
    return write_counted(df, lambda d: d.write.mode("overwrite").parquet(path))
