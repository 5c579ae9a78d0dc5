"""Log collection: responses of the log API and log files become sources and chunks.

The corpus under a base folder grows by batches. A batch writes its own sources and chunks and
costs what it holds, however large the corpus is; writing it again replaces it. Its sources and chunks are
published together (see ``sources/parts.py``), so a reader never sees one without the other. What is
current is decided on reading, by the rules of the upsert: ``current_sources`` folds the batches,
``current_chunks`` takes each source's chunks from the last batch that has any. ``publish_logs``
folds new batches into a run of both tables, and runs of one level into one of the next (see ``sources/levels.py``), so that
a batch is written again a logarithmic number of times; readers fold the few runs that are live.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from brontide.functions import text as X
from brontide.operators import logs as L
from brontide.operators.chunking import MAX_CHARS, MAX_LINES, chunk_lines
from brontide.operators.upsert import fold_batch, fold_rows
from brontide.schemas import LOG_CHUNK, LOG_SOURCE
from brontide.session import materialize, small_frame
from brontide.sources import files, levels, parts, tables
from brontide.sources.attempt_logs import ATTEMPT_KEYS, hash_attempts, scan_attempt_lines, scan_attempt_logs, scan_attempt_sizes

# Over batches: rows apply in the order of their batch, and the last one is kept with the row.
_ACROSS_BATCHES = replace(L.LOG_SOURCE_RULE, seq="batch",
                          overwrite=(*L.LOG_SOURCE_RULE.overwrite, "batch"))
_SCHEMAS = {"log_sources": LOG_SOURCE, "log_chunks": LOG_CHUNK}
_KEYS = {"log_sources": "id", "log_chunks": "log_source_id"}
_BATCH = T.StructField("batch", T.LongType())


def log_texts(responses: DataFrame) -> DataFrame:
    """Text sources from rows with ``content_type, body`` of an API response."""
    nothing = F.lit(None).cast("string")
    return L.decode_payload(responses, "raw_text").withColumns(
        {"raw_content": nothing, "raw_json": nothing})


def append_logs(incoming: DataFrame, base: str, batch: int, *, max_lines: int = MAX_LINES,
                max_chars: int = MAX_CHARS, allowed: L.Allowed | None = None) -> dict[str, int]:
    """Add a batch of sources ``raw_text, raw_content, raw_json`` and the chunks of its texts.

    ``incoming`` has the key columns of a source, its descriptive columns and ``seq``, the order
    in which rows apply. Batches apply in the order of their numbers. With ``allowed``, lists of values by
    column, rows with other values go to the batch's folder of the ``quarantine`` instead. Returns the rows
    written.
    """
    spark, written_rows = incoming.sparkSession, {}
    if allowed:
        incoming, rejected = L.split_allowed(incoming, allowed)
        written_rows["quarantine"] = tables.write_parquet(rejected, f"{base}/quarantine/batch={batch}")
    sources, chunks = (f"{base}/{t}/batch={batch}" for t in ("log_sources", "log_chunks"))
    run, sources = parts.new_run(), _fold_sources(incoming)
    written_rows["log_sources"] = parts.stage(sources.withColumn("part", F.lit(batch)), base, "log_sources", run)
    chunks = _text_chunks(spark, base, run, max_lines, max_chars)
    written_rows["log_chunks"] = parts.stage(chunks.withColumn("part", F.lit(batch)), base, "log_chunks", run)
    parts.publish(spark, base, run, [batch])
    return written_rows


def _fold_sources(incoming: DataFrame) -> DataFrame:
    stamped = (L.route_sources(incoming).withColumn("id", L.source_id())
                .withColumn("collected_at", F.current_timestamp()))
    return fold_batch(stamped, L.LOG_SOURCE_RULE).select(*LOG_SOURCE.names)


def _text_chunks(spark: SparkSession, base: str, run: str, max_lines: int, max_chars: int) -> DataFrame:
    """Chunks of the staged sources that hold their text."""
    written = spark.read.schema(LOG_SOURCE).parquet(f"{base}/log_sources/run={run}")
    texts = written.filter((F.col("content_type") == "TEXT") & F.col("raw_content").isNotNull())
    return L.chunk_sources(texts, max_lines, max_chars).select(*LOG_CHUNK.names)


def collect_stream(responses: DataFrame, base: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append every micro-batch of responses to the corpus."""
    def add(batch: DataFrame, batch_id: int) -> None:
        append_logs(log_texts(batch), base, batch_id)

    return (responses.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
                     .trigger(**(trigger or {"availableNow": True})).start())


def _with_batch(table: str) -> T.StructType:
    return T.StructType([*_SCHEMAS[table], _BATCH])


def _done(spark: SparkSession, target: str | None) -> int | None:
    """The last batch that the published tables hold."""
    runs = [] if target is None else levels.state(spark, target)[1]
    return runs[-1].upto if runs else None


def _runs(spark: SparkSession, target: str, table: str, runs: list[levels.Run]) -> DataFrame:
    """The rows of some runs: of a run each key has the rows of one batch."""
    return spark.read.schema(_with_batch(table)).parquet(*[f"{target}/{table}/run={r.name}" for r in runs])


def published(spark: SparkSession, target: str, table: str, keys: list[str] | None = None) -> DataFrame:
    """The published table of ``log_sources`` or ``log_chunks``, with the ``batch`` of each row.

    With ``keys``, some ids of sources, files and row groups that cannot hold them are skipped.
    """
    runs = levels.state(spark, target)[1]
    if not runs:
        return small_frame(spark, [], _with_batch(table))
    rows = _runs(spark, target, table, runs)
    if keys is not None:
        rows = rows.filter(F.col(_KEYS[table]).isin(keys))
    return rows if len(runs) == 1 else _LATEST[table](rows)


def _batches(spark: SparkSession, base: str, table: str, done: int | None, upto: int | None = None) -> DataFrame:
    rows = parts.scan(spark, base, table, _SCHEMAS[table]).withColumnRenamed("part", "batch")
    rows = rows if done is None else rows.filter(F.col("batch") > done)
    return rows if upto is None else rows.filter(F.col("batch") <= upto)


def _all_rows(spark: SparkSession, base: str, target: str | None, table: str) -> DataFrame:
    """The published rows, if there are any, and the batches after them."""
    runs = [] if target is None else levels.state(spark, target)[1]
    rows = _batches(spark, base, table, runs[-1].upto if runs else None)
    return _runs(spark, target, table, runs).unionByName(rows) if runs else rows


def _latest_sources(rows: DataFrame) -> DataFrame:
    return fold_rows(rows, _ACROSS_BATCHES).select(*LOG_SOURCE.names, "batch")


def _latest_chunks(rows: DataFrame) -> DataFrame:
    last = materialize(rows.groupBy("log_source_id").agg(F.max("batch").alias("batch")), "last-batches")
    return rows.join(last, ["log_source_id", "batch"], "left_semi").select(*LOG_CHUNK.names, "batch")


def current_sources(spark: SparkSession, base: str, target: str | None = None) -> DataFrame:
    """Every source once, with the effect of all batches."""
    return _latest_sources(_all_rows(spark, base, target, "log_sources"))


def current_chunks(spark: SparkSession, base: str, target: str | None = None) -> DataFrame:
    """The chunks of every source from the last batch that brought it any."""
    return _latest_chunks(_all_rows(spark, base, target, "log_chunks"))


_LATEST = {"log_sources": _latest_sources, "log_chunks": _latest_chunks}
_ORDER = {"log_sources": ("id",), "log_chunks": ("log_source_id", "chunk_index")}


def _stage_run(rows: dict[str, DataFrame], target: str, run: levels.Run) -> dict[str, int]:
    """Write a run of both tables, folded, in ranges of the sources; returns the rows written."""
    written = {}
    for table, own in rows.items():
        kept = levels.sorted_by(_LATEST[table](own), *_ORDER[table])
        path, options = f"{target}/{table}/run={run.name}", levels.key_filters(_KEYS[table])
        written[table] = tables.write_counted(kept, lambda d: d.write.options(**options).parquet(path))
    return written


def publish_logs(spark: SparkSession, base: str, target: str, fanout: int = 8, keep: int = 10) -> dict[str, int]:
    """Bring the tables of sources and chunks under ``target`` up to date; returns the rows written.

    New batches become a run. Where ``fanout`` runs of a level are there, they become one of the next level, of which both
    tables appear together. A batch that arrives meanwhile is left for the next time; of two writers one starts over. Files
    that no reader of the last ``keep`` publications needs are deleted, batches that the tables hold among them.
    """
    files.make_folder(spark, f"{target}/runs")
    while True:
        version, runs = levels.state(spark, target)
        upto = parts.live_parts(spark, base).agg(F.max("part")).first()[0]
        if upto is None or (runs and upto <= runs[-1].upto):
            return {table: 0 for table in _SCHEMAS}
        done = runs[-1].upto if runs else None
        run = levels.new_run(0, 0 if done is None else done + 1, upto)
        staged = [run]
        written = _stage_run({table: _batches(spark, base, table, done, upto) for table in _SCHEMAS}, target, run)
        runs = [*runs, run]
        while old := levels.due(runs, fanout):
            runs, run = levels.merged(runs, old)
            staged.append(run)
            again = _stage_run({table: _runs(spark, target, table, old) for table in _SCHEMAS}, target, run)
            written = {table: n + again[table] for table, n in written.items()}
        done = levels.commit(spark, target, version, runs)
        levels.discard(spark, target, list(_SCHEMAS), staged, runs if done else [])
        if done:
            break
    levels.prune(spark, target, list(_SCHEMAS), keep)
    parts.prune(spark, base, list(_SCHEMAS), keep, drop_parts=upto)
    return written


def attempt_chunks(spark: SparkSession, root: str, max_lines: int = MAX_LINES,
                   max_chars: int = MAX_CHARS) -> DataFrame:
    """Annotated chunks of all task logs under ``root``, whatever their length."""
    chunks = chunk_lines(scan_attempt_lines(spark, root), ATTEMPT_KEYS, max_lines, max_chars)
    return L.annotate_chunks(chunks)


def _same_attempt(a: DataFrame, b: DataFrame) -> Column:
    same = [a[k].eqNullSafe(b[k]) for k in ATTEMPT_KEYS]
    return same[0] & same[1] & same[2] & same[3] & same[4]


def append_attempts(spark: SparkSession, root: str, runs: DataFrame, base: str, batch: int, *, cell_bytes: int = 1 << 26,
                    max_lines: int = MAX_LINES, max_chars: int = MAX_CHARS, source_type: str = "AIRFLOW_LOG") -> dict[str, int]:
    """Add the task logs under ``root`` to the corpus as a batch; returns the rows written.

    ``runs`` has ``dag_id, dag_run_id, pipeline_run_id``, each run once; attempts of other runs go to the
    quarantine. Files without any bytes are none. A log of one file of at most ``cell_bytes`` is a source with its text. A longer one, and one in several
    files, is a source without text, and chunked by lines. The fingerprint of both is the SHA-256 of the text. Either way
    its chunks replace those of earlier batches, and an empty log leaves them.
    """
    nothing = F.lit(None).cast("string")
    names = runs.select(F.col("dag_id"), F.col("dag_run_id").alias("run_id"), "pipeline_run_id")
    attempts = materialize(scan_attempt_sizes(spark, root).join(names, ["dag_id", "run_id"], "left"), "attempts")
    counts = {"quarantine": tables.write_parquet(attempts.filter("pipeline_run_id is null"), f"{base}/quarantine/batch={batch}")}
    known = attempts.filter("pipeline_run_id is not null").select(
        *ATTEMPT_KEYS, "bytes", F.coalesce((F.col("files") == 1) & (F.col("bytes") <= cell_bytes), F.lit(False)).alias("short"),
        F.col("pipeline_run_id").cast("bigint").alias("pipeline_run_id"), F.lit(None).cast("bigint").alias("pipeline_task_run_id"),
        F.lit(source_type).alias("source_type"), nothing.alias("source_uri"), F.col("run_id").alias("dag_run_id"),
        F.col("attempt").alias("try_number"), nothing.alias("resource_type"), nothing.alias("resource_id"))
    short, long = materialize(known.filter("short"), "short-attempts"), materialize(known.filter("not short"), "long-attempts")
    described = ["pipeline_run_id", "pipeline_task_run_id", "source_type", "source_uri", "dag_id", "dag_run_id", "task_id", "try_number",
                 "map_index", "resource_type", "resource_id"]

    whole = scan_attempt_logs(spark, root, cell_bytes)
    texts = whole.join(short, _same_attempt(whole, short)).select(
        *[short[c] for c in described], "raw_text", nothing.alias("raw_content"), nothing.alias("raw_json"), F.lit(0).alias("seq"))
    run, sources = parts.new_run(), _fold_sources(texts)
    has_long = long.limit(1).count() > 0
    if has_long:
        lines = scan_attempt_lines(spark, root)
        lines = materialize(lines.join(long, _same_attempt(lines, long), "left_semi"), "long-lines")
        prints = materialize(hash_attempts(spark, root, long), "long-hashes")
        sizes = lines.groupBy(*ATTEMPT_KEYS).agg(F.count(F.lit(1)).cast("int").alias("line_count"))
        # A log without any line holds nothing but marks of its encoding.
        marks = F.repeat(F.lit("\ufeff"), (F.col("bytes") / 3).cast("int"))
        found = long.join(prints, _same_attempt(long, prints), "left").join(sizes, _same_attempt(long, sizes), "left").select(
            *[long[c] for c in [*described, "attempt"]], F.lit("TEXT").alias("content_type"), nothing.alias("raw_content"),
            nothing.alias("raw_json"), F.coalesce("content_hash", X.sha256_hex(marks)).alias("content_hash"),
            F.col("bytes").alias("content_size_bytes"), F.coalesce("line_count", F.lit(1)).alias("line_count"),
            F.current_timestamp().alias("collected_at"))
        found = materialize(found.withColumn("id", L.source_id()), "long-sources")
        sources = sources.unionByName(found.select(*LOG_SOURCE.names))
    counts["log_sources"] = parts.stage(sources.withColumn("part", F.lit(batch)), base, "log_sources", run)
    chunks = _text_chunks(spark, base, run, max_lines, max_chars)
    if has_long:
        cut = L.annotate_chunks(chunk_lines(lines, ATTEMPT_KEYS, max_lines, max_chars))
        owners = found.select(F.col("id").alias("log_source_id"), "pipeline_run_id", "pipeline_task_run_id", "source_type",
                              F.col("dag_run_id").alias("run_id"), *[k for k in ATTEMPT_KEYS if k != "run_id"])
        chunks = chunks.unionByName(cut.join(owners, _same_attempt(cut, owners)).select(*LOG_CHUNK.names))
    counts["log_chunks"] = parts.stage(chunks.withColumn("part", F.lit(batch)), base, "log_chunks", run)
    parts.publish(spark, base, run, [batch])
    return counts
