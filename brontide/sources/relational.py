"""Relational sources over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, *, partition_column: str | None = None,
                 lower_bound: int | str | None = None, upper_bound: int | str | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000,
                 **extra: str) -> dict[str, str]:
    """Reader options; the four partitioning arguments go together or not at all."""
    bounds = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(b is not None for b in bounds) and any(b is None for b in bounds):
        raise ValueError("partition_column, lower_bound, upper_bound and num_partitions go together")
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column is not None:
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                    "upperBound": str(upper_bound), "numPartitions": str(num_partitions)}
    return options


def scan_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """Whole table in its declared column order; in parallel when partition bounds are given."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()
