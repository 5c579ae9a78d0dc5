"""Task logs in the layout ``dag_id=/run_id=/task_id=/[map_index=/]attempt=N.log``.

The keys are read from the paths. Partition discovery is of no use here: it rejects a tree in
which only some logs have a ``map_index``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from brontide.functions.text import split_at_terminators
from brontide.operators.chunking import segment_shifts
from brontide.operators.quality import expected_bytes
from brontide.session import materialize

ATTEMPT_KEYS = ["dag_id", "run_id", "task_id", "map_index", "attempt"]
_READ = {"recursiveFileLookup": True}
_TASK_BYTES = 32 << 20


@contextmanager
def _few_listing_tasks(spark: SparkSession):
    """Within, a tree is listed by some tasks a core, not by one for each of its many folders."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, 8 * spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _path_keys(path: Column) -> list[Column]:
    def part(name: str, value: str = "[^/]*") -> Column:
        # Paths come percent-encoded; a plus sign stands for itself.
        raw = F.nullif(F.regexp_extract(path, f"/{name}=({value})(?:/|\\.log|$)", 1), F.lit(""))
        return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))

    return [part("dag_id").alias("dag_id"), part("run_id").alias("run_id"),
            part("task_id").alias("task_id"),
            part("map_index", "[0-9]+").cast("int").alias("map_index"),
            part("attempt", "[0-9]+").cast("int").alias("attempt")]


def scan_attempt_sizes(spark: SparkSession, root: str) -> DataFrame:
    """One row per attempt with its keys, ``bytes`` and number of ``files``; nothing is read."""
    with _few_listing_tasks(spark):
        files = spark.read.format("binaryFile").options(**_READ).load(root)
    keyed = files.select(*_path_keys(F.col("_metadata.file_path")), F.col("_metadata.file_size").alias("_size"))
    return keyed.groupBy(*ATTEMPT_KEYS).agg(F.sum("_size").alias("bytes"), F.count(F.lit(1)).alias("files"))


def scan_attempt_logs(spark: SparkSession, root: str, max_bytes: int | None = None) -> DataFrame:
    """One row per log file with its keys and whole text. For logs that fit in a cell; with ``max_bytes``
    longer files are not opened. However many the files, they are read by tasks of some tens of megabytes."""
    with _few_listing_tasks(spark):
        files = spark.read.options(**_READ).text(root, wholetext=True)
    # Spark gives a task few files, as if each had megabytes; by their bytes they need fewer tasks.
    files = files.coalesce(max(8 * spark.sparkContext.defaultParallelism, expected_bytes(files) // _TASK_BYTES))
    if max_bytes is not None:
        files = files.filter(F.col("_metadata.file_size") <= max_bytes)
    return files.select(*_path_keys(F.col("_metadata.file_path")), F.col("value").alias("raw_text"))


def scan_attempt_lines(spark: SparkSession, root: str) -> DataFrame:
    """One row per line with its keys and its number, for logs of any length.

    Spark splits the files between tasks; lines are numbered afterwards from the counts per
    split. An attempt may consist of several files, in the order of their names. The lines are
    stored once in the shared folder, so the text is parsed once.
    """
    meta = F.col("_metadata")
    files = spark.read.options(**_READ, lineSep="\n").text(root).select(
        meta["file_path"].alias("_path"), meta["file_block_start"].alias("_block"),
        meta["file_size"].alias("_size"), F.octet_length("value").alias("_bytes"),
        # "\r" at the end belongs to "\r\n"; the other terminators split what the reader left.
        split_at_terminators(F.regexp_replace("value", "\r\\z", "")).alias("_lines"))
    lines = files.select("_path", "_block", "_size", "_bytes",
                         F.posexplode_outer("_lines").alias("_pos", "line"))
    stored = materialize(lines.withColumn("_id", F.monotonically_increasing_id()), "attempt-lines")

    shifts = materialize(segment_shifts(_segments(stored), ATTEMPT_KEYS, ["_path", "_block"])
                         .select("_path", "_block", *ATTEMPT_KEYS, "_shift", "_skip"), "shifts")
    return (stored.join(shifts, ["_path", "_block"])
                  .filter(F.col("_skip").isNull() | (F.col("_id") != F.col("_skip")))
                  .select(*ATTEMPT_KEYS, (F.col("_id") + F.col("_shift")).alias("line_no"), "line"))


def _segments(stored: DataFrame) -> DataFrame:
    """Row counts per split of a file.

    A file whose last line has no line feed but ends in another terminator yields an empty piece
    behind it that is no line; ``_skip`` is the ``_id`` of that piece. Such a file has one byte
    less than its lines with a line feed each.
    """
    blank_piece = (F.col("_pos") > 0) & (F.col("line") == "")
    per_split = stored.groupBy("_path", "_block").agg(
        F.min("_id").alias("_first"), F.max("_id").alias("_last"),
        F.count(F.lit(1)).alias("_n"), F.first("_size").alias("_size"),
        F.sum(F.when(F.col("_pos") == 0, F.col("_bytes") + 1)).alias("_read"),
        F.max_by(blank_piece, "_id").alias("_blank"))
    file = Window.partitionBy("_path")
    skipped = (F.col("_blank") & (F.col("_block") == F.max("_block").over(file))
               & (F.sum("_read").over(file) == F.col("_size") + 1))
    flagged = per_split.withColumn("_skip", F.when(skipped, F.col("_last")))
    return flagged.select(
        *_path_keys(F.col("_path")), "_path", "_block", "_first", "_skip",
        (F.col("_n") - F.when(F.col("_skip").isNotNull(), 1).otherwise(0)).alias("_n"))


def _running_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per log of sorted rows ``log, file, size, bytes``; of its text only the state of the hash is held."""
    log = file = digest = None
    size, read, mark = 0, 0, False

    def end_file() -> None:
        # A last line with a line feed is one byte longer than what the reader gave.
        if file is not None and size >= read:
            digest.update(b"\n")

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([log]), pa.array([digest.hexdigest()])], names=["log", "content_hash"])

    for batch in batches:
        for own, path, total, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
            if (own, path) != (log, file):
                end_file()
                if own != log:
                    if log is not None:
                        yield row()
                    log, digest = own, hashlib.sha256()
                file, size, read, mark = path, total, 0, total < 0
            elif mark:
                # Behind the mark, of three bytes, the file begins.
                size, mark = total - 3, False
            else:
                digest.update(b"\n")
            line = raw.as_buffer()
            digest.update(line)
            if not mark:
                read += line.size + 1
    end_file()
    if log is not None:
        yield row()


def hash_attempts(spark: SparkSession, root: str, attempts: DataFrame) -> DataFrame:
    """``content_hash``, the SHA-256 of the text, of some attempts given by their keys, whatever their length.

    The lines of a log meet in one task, in their order, and run through one hash there; no two of them are held
    together. Several files of a log are one text, in the order of their names. An attempt without any bytes has no row.
    """
    meta = F.col("_metadata")
    files = spark.read.options(**_READ, lineSep="\n").text(root).select(
        *_path_keys(meta["file_path"]), meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), meta["file_size"].alias("size"),
        F.monotonically_increasing_id().alias("id"), F.col("value").cast("binary").alias("bytes"))
    wanted = attempts.select(*[F.col(k).alias(f"_{k}") for k in ATTEMPT_KEYS], F.to_json(F.array(*[F.col(k).cast("string") for k in ATTEMPT_KEYS])).alias("log"))
    same = F.lit(True)
    for k in ATTEMPT_KEYS:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    lines = files.join(wanted, same).select("log", "file", "block", "id", "size", "bytes")
    # The reader drops the mark that a file of UTF-8 may begin with; two or three bytes are missing then.
    read = files.groupBy(*ATTEMPT_KEYS, "file").agg(F.sum(F.octet_length("bytes") + 1).alias("read"), F.max("size").alias("size"))
    marked = read.filter(F.col("size") - F.col("read") >= 2).join(wanted, same).select(
        "log", "file", F.lit(-1).cast("long").alias("block"), F.lit(-1).cast("long").alias("id"), F.lit(-1).cast("long").alias("size"),
        F.lit(b"\xef\xbb\xbf").alias("bytes"))
    order = ["log", "file", "block", "id"]
    dealt = lines.unionByName(marked).repartition("log").sortWithinPartitions(*order)
    hashed = dealt.select("log", "file", "size", "bytes").mapInArrow(_running_hash, "log string, content_hash string")
    return hashed.join(wanted, "log").select(*[F.col(f"_{k}").alias(k) for k in ATTEMPT_KEYS], "content_hash")
