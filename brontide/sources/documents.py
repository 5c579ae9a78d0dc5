"""Per-table JSON documents: metadata of an export and data-quality reports."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from brontide.schemas import DQ_REPORT, TABLE_METADATA
from brontide.session import small_frame
from brontide.sources.tables import path_exists


def _write_document(df: DataFrame, path: str) -> None:
    # One row by construction, hence one file.
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_metadata(document: DataFrame, metadata_dir: str, table: str) -> None:
    """Write the one-row metadata document of a table."""
    _write_document(document.select(*TABLE_METADATA.names), f"{metadata_dir}/{table}.json")


def read_metadata(spark: SparkSession, metadata_dir: str, table: str) -> DataFrame:
    """Metadata of one table; no rows where the table has no document."""
    path = f"{metadata_dir}/{table}.json"
    if not path_exists(spark, path):
        return small_frame(spark, [], TABLE_METADATA)
    return spark.read.schema(TABLE_METADATA).option("multiLine", True).json(path)


def declared_primary_keys(spark: SparkSession, metadata_dir: str, table: str) -> list[str]:
    """Primary keys of a table; empty when it has no metadata, which turns key checks off."""
    row = read_metadata(spark, metadata_dir, table).select("primary_keys").first()
    return list(row["primary_keys"] or []) if row else []


# Column types as an export of this package writes them. Other writers' metadata may name types
# of their own database, which say little about the text in the file.
_OWN_TYPE = re.compile(r"(tinyint|smallint|int|bigint|float|double|boolean|string|date|timestamp"
                       r"|timestamp_ntz|decimal\(\d+,\d+\))")


def declared_schema(spark: SparkSession, metadata_dir: str, table: str,
                    infer: Callable[[], T.StructType] | None = None) -> T.StructType | None:
    """Schema of a landed table by its metadata, or None where there is none.

    Columns of types that are not ours take theirs from ``infer``, by name, and the others keep what was
    declared; without ``infer``, or where it lacks one, the whole schema has to be inferred.
    """
    row = read_metadata(spark, metadata_dir, table).select("columns").first()
    columns = sorted(row["columns"] or [], key=lambda c: c["cid"]) if row else []
    known = {c["name"]: T.DataType.fromDDL(c["type"]) for c in columns if c["type"] and _OWN_TYPE.fullmatch(c["type"])}
    if not columns:
        return None
    if len(known) < len(columns):
        inferred = {f.name: f.dataType for f in infer()} if infer and known else {}
        if not all(c["name"] in known or c["name"] in inferred for c in columns):
            return None
        known = {**inferred, **known}
    return T.StructType([T.StructField(c["name"], known[c["name"]]) for c in columns])


def with_primary_keys(tables: DataFrame, metadata: DataFrame) -> DataFrame:
    """Add ``primary_keys`` to rows that have a ``table``; empty where metadata is missing."""
    keys = metadata.select("table", "primary_keys")
    return (tables.join(keys, "table", "left")
                  .withColumn("primary_keys",
                              F.coalesce("primary_keys", F.array().cast("array<string>"))))


def write_dq_report(report: DataFrame, metadata_dir: str, table: str) -> None:
    _write_document(report.select(*DQ_REPORT.names), f"{metadata_dir}/{table}_dq_report.json")


def read_dq_report(spark: SparkSession, metadata_dir: str, table: str) -> DataFrame:
    return (spark.read.schema(DQ_REPORT).option("multiLine", True)
                 .json(f"{metadata_dir}/{table}_dq_report.json"))
