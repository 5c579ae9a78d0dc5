"""Table ingestion: export, cleanse, check, load and validate.

Each stage hands over files, and nothing becomes visible to readers before its gates passed.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from brontide.operators import quality as Q
from brontide.schemas import INGEST_REPORT
from brontide.session import passing_files, passing_shuffles, small_frame
from brontide.sources import artifacts, csv, documents, files, tables


@dataclass(frozen=True)
class TableSpec:
    name: str
    primary_keys: tuple[str, ...] = ()
    foreign_keys: tuple[Q.ForeignKey, ...] = ()
    min_rows: int = 0


@dataclass(frozen=True)
class Folders:
    csv: str
    cleansed: str
    metadata: str
    target: str

    @classmethod
    def under(cls, base: str) -> "Folders":
        return cls(*(f"{base}/{part}" for part in ("csv", "cleansed", "metadata", "bronze")))

    def csv_path(self, table: str) -> str:
        return f"{self.csv}/{table}.csv"


def export_table(source: DataFrame, spec: TableSpec, folders: Folders) -> int:
    """Land a table as CSV with its metadata document; returns the rows written.

    From ``csv.PACK_FROM`` bytes of text on the files are compressed: as text a table has several times its bytes in Parquet.
    """
    path = folders.csv_path(spec.name)
    dealt, rows_per_file, n_bytes = csv.landing(source)
    n_rows = tables.write_counted(dealt, lambda df: csv.write_csv(df, path, rows_per_file, n_bytes >= csv.PACK_FROM))
    document = Q.table_metadata(source.sparkSession, spec.name, source.schema, spec.primary_keys,
                                spec.foreign_keys, n_rows, path)
    documents.write_metadata(document, folders.metadata, spec.name)
    return n_rows


def cleanse_table(spark: SparkSession, table: str, folders: Folders,
                  infer_types: bool = False) -> DataFrame:
    """Cleanse a landed table, gate it, publish it with its report; returns the report.

    With the types of its metadata the CSV is read once; to infer them takes another pass. All
    counts come from one aggregation over the staged result. Of a large table all rows are staged first, to look at them
    twice (see ``Q.dedup_counting``), and that is the result unless some repeat. What is not published is deleted.
    """
    path = folders.csv_path(table)
    schema = None if infer_types else documents.declared_schema(
        spark, folders.metadata, table, lambda: csv.scan_csv(spark, path).schema)
    landed = csv.scan_csv(spark, path, schema)
    each = Q.counted_once(Q.trimmed(landed))
    keys = documents.declared_primary_keys(spark, folders.metadata, table)
    Q.require_keys_present(each, keys)

    # Decided by the text: stored with its types, the table is several times smaller.
    if Q.looked_at_twice(landed, Q.DIGEST_FROM, csv.text_bytes(spark, path)):
        staged = _stage_distinct(spark, each, folders.cleansed, table)
    else:
        staged = tables.stage_snapshot(Q.cleanse(landed), folders.cleansed, table)
    with _deleted_if_refused(spark, staged):
        counted = Q.quality_metrics(spark.read.schema(each.schema).parquet(staged.path), keys)
        metrics = counted.first().asDict()
        Q.require_quality(table, metrics, keys)

        one_row = small_frame(spark, [metrics], counted.schema)
        report = Q.quality_report(table, one_row, keys, path, staged.path)
        documents.write_dq_report(report, folders.metadata, table)
    tables.publish_snapshot(spark, staged)
    return report


def _stage_distinct(spark: SparkSession, each: DataFrame, base: str, table: str) -> tables.Snapshot:
    """The distinct rows of ``each`` with their copies as a snapshot; they are written a second time only if some repeat."""
    whole = tables.stage_snapshot(each, base, table)
    with _deleted_if_refused(spark, whole), passing_files(spark):
        counted = Q.counted_repeats(spark.read.schema(each.schema).parquet(whole.path).drop(Q.COPIES))
        if counted is None:
            return whole
        staged = tables.stage_snapshot(counted, base, table)
    files.delete_path(spark, whole.path)
    return staged


@contextmanager
def _deleted_if_refused(spark: SparkSession, staged: tables.Snapshot):
    """Nobody knows of a snapshot that is not published, and a large one is not to stay on the disk."""
    try:
        yield
    except Exception:
        files.delete_path(spark, staged.path)
        raise


def read_cleansed(spark: SparkSession, folders: Folders, table: str) -> DataFrame:
    return tables.scan_table(spark, folders.cleansed, table, "parquet").drop(Q.COPIES)


def load_table(spark: SparkSession, table: str, folders: Folders, fmt: str | None = None,
               min_rows: int = 0) -> int:
    """Copy the cleansed table to the target and compare the rows read with those found there.

    With ``min_rows`` a shorter table is not loaded at all. A snapshot is published only if the
    counts agree; other formats are checked afterwards.
    """
    source, fmt = read_cleansed(spark, folders, table), fmt or tables.default_format(spark)
    if min_rows:
        Q.require_min_rows(source, table, min_rows)
    if fmt == "parquet":
        staged = tables.stage_snapshot(source, folders.target, table)
        with _deleted_if_refused(spark, staged):
            loaded = spark.read.schema(source.schema).parquet(staged.path).count()
            Q.require_equal_counts(table, staged.n_rows, loaded)
        tables.publish_snapshot(spark, staged)
    else:
        read = tables.write_table(source, folders.target, table, fmt)
        loaded = tables.scan_table(spark, folders.target, table, fmt).count()
        Q.require_equal_counts(table, read, loaded)
    return loaded


def validate_table(spark: SparkSession, table: str, folders: Folders, min_rows: int = 0,
                   fmt: str | None = None) -> int:
    """Gate on the published row count."""
    return Q.require_min_rows(tables.scan_table(spark, folders.target, table, fmt), table, min_rows)


def ingest_table(source: DataFrame, spec: TableSpec, folders: Folders, *,
                 infer_types: bool = False, fmt: str | None = None) -> DataFrame:
    """The whole chain for one table; returns its report with ``target_rows`` added.

    ``infer_types`` derives the types from the landed text, as for CSV of unknown origin;
    otherwise the landing is read with the source's own types and one pass is saved.
    """
    with passing_shuffles(source.sparkSession):
        return _ingest_table(source, spec, folders, infer_types, fmt)


def _ingest_table(source: DataFrame, spec: TableSpec, folders: Folders, infer_types: bool = False, fmt: str | None = None) -> DataFrame:
    spark = source.sparkSession
    export_table(source, spec, folders)
    artifacts.require_artifact(spark, folders.csv_path(spec.name))
    report = cleanse_table(spark, spec.name, folders, infer_types)
    load_table(spark, spec.name, folders, fmt, spec.min_rows)
    target_rows = validate_table(spark, spec.name, folders, spec.min_rows, fmt)
    return report.withColumn("target_rows", F.lit(target_rows).cast("bigint"))


def ingest_tables(sources: dict[str, DataFrame], specs: list[TableSpec], folders: Folders,
                  parallelism: int = 4, **options) -> DataFrame:
    """Ingest independent tables side by side; one report row each, also for a table that fails.

    ``status`` is ``ok`` or ``failed``, and ``reason`` says why; a failed table publishes nothing and stops
    no other. Each table is a handful of Spark jobs in a pool of its own; where the session schedules fairly
    (``build_session`` does) a large table does not keep the small ones waiting.
    """
    spark = next(iter(sources.values())).sparkSession

    def run(spec: TableSpec) -> DataFrame:
        try:
            done = _ingest_table(sources[spec.name], spec, folders, **options)
            return done.withColumns({"status": F.lit("ok"), "reason": F.lit(None).cast("string")})
        except Exception as error:  # whatever ends a table is its row of the report
            reason = str(error).strip().splitlines()[0] if str(error).strip() else type(error).__name__
            return small_frame(spark, [{"table": spec.name, "status": "failed", "reason": reason}], INGEST_REPORT)

    with passing_shuffles(spark):
        reports = side_by_side(spark, {spec.name: partial(run, spec) for spec in specs}, parallelism)
    return Q.union_all([report.to(INGEST_REPORT) for report in reports])


def side_by_side(spark: SparkSession, work: dict[str, Callable[[], DataFrame]], parallelism: int = 4) -> list[DataFrame]:
    """Results of independent pieces of work, in their order, each with its Spark jobs in a pool of its name."""
    def run(name: str) -> DataFrame:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return work[name]()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(run), work))
