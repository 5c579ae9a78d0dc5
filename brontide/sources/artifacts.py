"""Checks of files between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brontide.errors import DataQualityError
from brontide.sources.tables import path_exists


def artifact_inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row: number of files, their bytes and whether there is any content.

    Only path and length are read, not the content.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return (files.load(path).select("path", "length")
                 .agg(F.count("path").alias("n_files"),
                      F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"))
                 .withColumn("non_empty", F.col("n_bytes") > 0))


def require_artifact(spark: SparkSession, path: str) -> None:
    """Fail unless ``path`` exists and holds at least one byte."""
    if not path_exists(spark, path) or not artifact_inventory(spark, path).first()["non_empty"]:
        raise DataQualityError(f"missing or empty: {path}")
