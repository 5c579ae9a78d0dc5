"""Tables in parts: a run of a writer replaces some parts of several tables at once.

Under ``root`` each table has the files of a run in ``{table}/run=R/part=P``. A run is not seen until its rows are
in the ``manifest``, one per part it replaces; of the rows of a part the latest run counts. So a reader finds
all tables of a run or none, a failed run leaves nothing visible, and a run costs the parts it writes.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from brontide.schemas import MANIFEST
from brontide.session import materialize, small_frame
from brontide.sources import commits
from brontide.sources.files import delete_path, list_names, make_folder, path_exists
from brontide.sources.tables import write_counted


def new_run() -> str:
    return uuid.uuid4().hex


def stage(df: DataFrame, root: str, table: str, run: str) -> int:
    """Write the rows of a run, by their column ``part``; returns how many."""
    return write_counted(df, lambda d: d.write.partitionBy("part").parquet(f"{root}/{table}/run={run}"))


def publish(spark: SparkSession, root: str, run: str, parts: list[int], upto: int | None = None) -> None:
    """Make a staged run the current one of its parts. Of several writers each gets a version of its own."""
    make_folder(spark, f"{root}/manifest")
    commits.commit(spark, f"{root}/manifest", lambda version: _lines(
        [{"part": part, "run": run, "version": version, "upto": upto} for part in parts]))


def _lines(rows: list[dict]) -> str:
    return "\n".join(json.dumps(r) for r in rows)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Every publication that is still listed."""
    if not path_exists(spark, f"{root}/manifest"):
        return small_frame(spark, [], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{root}/manifest")


def live_parts(spark: SparkSession, root: str) -> DataFrame:
    """``part, run, version, upto`` of the current run of each part."""
    found = manifest(spark, root).groupBy("part").agg(F.max(F.struct("version", "run", "upto")).alias("last"))
    return found.select("part", "last.*")


def scan(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """Current rows with their ``part``."""
    if not path_exists(spark, f"{root}/{table}"):
        return small_frame(spark, [], T.StructType([*schema, T.StructField("part", T.LongType())]))
    rows = spark.read.schema(f"{schema.toDDL()}, run STRING, part BIGINT").parquet(f"{root}/{table}")
    # Stored now, a row per part, as the manifest may be pruned before the rows are read.
    current = materialize(live_parts(spark, root).select("part", "run"), "live-parts")
    return rows.join(current, ["part", "run"], "left_semi").select(*schema.names, "part")


def prune(spark: SparkSession, root: str, tables: list[str], keep: int, drop_parts: int | None = None) -> None:
    """Forget what no reader needs: runs that are neither current nor among the last ``keep`` publications.

    With ``drop_parts`` the parts up to that number are forgotten too, as another table holds them by now. The
    manifest is written anew before the files go; readers that began within the last ``keep``
    publications find theirs.
    """
    rows = [r.asDict() for r in manifest(spark, root).collect()]
    newest: dict[int, dict] = {}
    for r in rows:
        if r["part"] not in newest or r["version"] > newest[r["part"]]["version"]:
            newest[r["part"]] = r
    last = max((r["version"] for r in rows), default=0)
    gone = lambda r: drop_parts is not None and r["part"] <= drop_parts
    kept = [r for r in rows if r["version"] > last - keep or (newest[r["part"]] is r and not gone(r))]
    if len(kept) == len(rows) and len(list_names(spark, f"{root}/manifest")) <= 2 * keep + 2:
        return
    # Files of before go only after the one that holds what is kept is there; rows that are seen twice in
    # between change nothing. Its name carries the last version, from which the next writer goes on.
    before = [name for number, name in commits.versions(spark, f"{root}/manifest") if number <= last]
    if not commits.create_exclusively(spark, f"{root}/manifest/kept-{commits.name_of(last)}", _lines(kept)):
        return
    for name in before:
        delete_path(spark, f"{root}/manifest/{name}")
    runs = {r["run"] for r in kept}
    for table in tables:
        for name in list_names(spark, f"{root}/{table}"):
            if name.startswith("run=") and name.removeprefix("run=") not in runs:
                delete_path(spark, f"{root}/{table}/{name}")
