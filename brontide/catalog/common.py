"""Inputs shared by the registered queries.

A registered query is a pair: a function ``(spark, sf_dir) -> DataFrame`` and the SQL that gives
the same rows on the same tables, or None where there is no SQL for it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from brontide.streaming.tail import open_file_system

Query = Callable[[SparkSession, str], DataFrame]

# Declared keys of the given tables.
PRIMARY_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
    "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"],
    "documents": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"],
    "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}
TABLES = list(PRIMARY_KEYS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Registry:
    """Queries of one module with their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def register(query: Query) -> Query:
            self.queries[query.__name__] = query
            if sql is not None:
                self.sql[query.__name__] = sql
            return query
        return register


def union_sql(template: str, tables=TABLES) -> str:
    """``template`` once per table, with ``{t}`` for its name."""
    return " union all ".join(template.format(t=t, pk="+".join(PRIMARY_KEYS[t])) for t in tables)


# A log line per event, in words that cover every level and several error tokens.
LINE_EXPR = """concat(cast(event_id as varchar(20)), ' ', case event_type
  when 'error'  then 'ERROR Task Failed: Permission denied'
  when 'click'  then 'INFO ok'
  when 'view'   then 'debug noop'
  when 'signup' then 'Warning: slow'
  else 'plain timeout' end)"""

# Customers with padded names and blank segments, and those in debt a second time with other
# padding, so that the two become equal only after trimming.
BLANKS_EXPR = {
    "c_custkey": "c_custkey",
    "c_name": "case when c_custkey % 3 = 0 then concat('  ', c_name, ' ') else c_name end",
    "c_nationkey": "c_nationkey",
    "c_acctbal": "c_acctbal",
    "c_mktsegment": "case when c_custkey % 5 = 0 then '   ' else c_mktsegment end",
}
_PADDED = {**BLANKS_EXPR, "c_name": "concat('   ', c_name, '    ')"}
BLANKS_SQL = (
    f"select {', '.join(f'{e} as {c}' for c, e in BLANKS_EXPR.items())} from customer union all "
    f"select {', '.join(f'{e} as {c}' for c, e in _PADDED.items())} from customer "
    "where c_acctbal < 0")
# The same customers after trimming, as SQL.
CLEANSED_SQL = ("select distinct c_custkey, nullif(trim(c_name), '') as c_name, c_nationkey, "
                f"c_acctbal, nullif(trim(c_mktsegment), '') as c_mktsegment from ({BLANKS_SQL})")


def customers_with_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    again = customer.filter("c_acctbal < 0")
    return (customer.selectExpr(*[f"{e} as {c}" for c, e in BLANKS_EXPR.items()])
                    .unionAll(again.selectExpr(*[f"{e} as {c}" for c, e in _PADDED.items()])))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("line", F.expr(LINE_EXPR))


def write_attempts(lines: DataFrame, root: str, whole: bool = False) -> None:
    """Event lines as log files, one per event type and day, in the order of the events.

    The range partitioning splits a long log between tasks; its files then follow each other. With
    ``whole`` each log is one file.
    """
    logs = lines.select(
        F.col("event_type").alias("dag_id"), F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        F.lit("t").alias("task_id"), F.lit("1.log").alias("attempt"), "ts", "event_id", "line")
    order = ["dag_id", "run_id", "task_id", "attempt", "ts", "event_id"]
    dealt = logs.repartition(*order[:2]) if whole else logs.repartitionByRange(*order)
    (dealt.sortWithinPartitions(*order)
         .select(*order[:4], F.col("line").alias("value"))
         .write.partitionBy(*order[:4]).text(root))


# What Spark escapes in the names of the folders that it partitions by.
_ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")


def _folder(key: str, value: str | None) -> str:
    value = _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value) if value is not None else "__HIVE_DEFAULT_PARTITION__"
    return f"{key}={value}"


def write_small_logs(logs: DataFrame, root: str, keys: list[str]) -> int:
    """Lines, in ``value``, as the files that ``write.partitionBy(*keys).text(root)`` makes, one per task and log; returns the lines.

    For trees of very many short logs: Spark's writer takes some tens of milliseconds a file, and its driver then moves every
    file once more. A task that is run again writes the same files anew.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_file_system(root)
        name, log, out, n = f"part-{TaskContext.get().partitionId():05d}.txt", None, None, 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(len(keys))]
            for *own, line in zip(*columns, batch.column(len(keys))):
                if own != log:
                    if out is not None:
                        out.close()
                    log, folder = own, "/".join([base, *map(_folder, keys, own)])
                    system.create_dir(folder)
                    out = system.open_output_stream(f"{folder}/{name}")
                if line.is_valid:
                    out.write(line.as_buffer())
                out.write(b"\n")
                n += 1
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    # Null and empty keys share a folder.
    rows = logs.select(*[F.nullif(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys], F.col("value").cast("binary"))
    return rows.sortWithinPartitions(*keys).mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


@contextmanager
def splits_of(spark: SparkSession, size: int):
    """Files are split at so many bytes, and no two files or splits go to one task, as far as jobs run within."""
    names = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": size}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
