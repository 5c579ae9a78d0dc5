"""The log corpus: sources, resources and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brontide.functions import payload as P, text as X
from brontide.operators.chunking import MAX_CHARS, MAX_LINES, chunk_text
from brontide.operators.project import column
from brontide.operators.upsert import UpsertRule, upsert
from brontide.session import materialize

# A log source: one text or JSON body per attempt or resource. The spelling of the key columns
# (NULL, '' or 0) stays as first written, but for ``map_index``.
_SOURCE_KEY = {
    "pipeline_run_id": None, "pipeline_task_run_id": 0, "source_type": None, "task_id": "",
    "try_number": 0, "map_index": -1, "resource_id": "",
}
LOG_SOURCE_RULE = UpsertRule(
    key=_SOURCE_KEY,
    keep=("id", "pipeline_run_id", "source_type", "task_id", "try_number", "resource_id"),
    fill=("pipeline_task_run_id",),
    overwrite=("content_type", "source_uri", "dag_id", "dag_run_id", "map_index",
               "resource_type", "raw_content", "raw_json", "content_hash",
               "content_size_bytes", "line_count", "collected_at"))

RESOURCE_RULE = UpsertRule(
    key={"pipeline_run_id": None, "pipeline_task_run_id": 0, "resource_type": None,
         "resource_id": None},
    keep=("pipeline_run_id", "resource_type", "resource_id"),
    fill=("pipeline_task_run_id", "resource_name", "parent_resource_type", "parent_resource_id",
          "namespace", "cluster_name", "application_id", "started_at", "finished_at",
          "duration_sec"),
    overwrite=("discovered_from", "confidence", "raw_payload", "updated_at"))


def source_id(key: dict[str, object] = _SOURCE_KEY) -> Column:
    """Identifier of a log source, a 128-bit digest of its key: the same on every run, and wide
    enough for billions of sources."""
    parts = [column(c).cast("string") if default is None
             else F.coalesce(column(c).cast("string"), F.lit(str(default)))
             for c, default in key.items()]
    return F.md5(F.to_json(F.array(*parts)))


def extract_log_text(df: DataFrame, payload: str = "payload", name: str = "text") -> DataFrame:
    """Replace a column of JSON payloads by the log texts they hold.

    NULL and JSON null give ''; a string itself; a list the texts of its elements on lines of
    their own; an object the text under the first of ``payload.TEXT_KEYS`` that has one, else the
    texts of all its strings, lists and objects, else its JSON; any other scalar its JSON. Text
    that is not JSON is the log itself.

    Flat payloads, which are nearly all, stay in the JVM. Python gets the irregular rest; for the
    other rows its argument is NULL.
    """
    others = [column(c) for c in df.columns if c != payload]
    named = df.select(*others, column(payload).alias("_payload"))
    flat = named.select("*", P.regular_text("_payload").alias("_flat"))
    rest = P.irregular_text(F.when(F.col("_flat").isNull(), F.col("_payload")))
    return flat.select(*others, F.coalesce("_flat", rest).alias(name))


def decode_payload(df: DataFrame, name: str = "text") -> DataFrame:
    """Replace ``content_type, body`` of a response by its log text: extracted from the body if
    the content type says JSON, else the body as it is."""
    is_json = P.is_json(F.col("content_type"))
    # Only what is declared as JSON is looked into; any other body is the text, whatever its size.
    split = df.withColumns({"_plain": F.when(~is_json, F.coalesce("body", F.lit(""))),
                            "body": F.when(is_json, F.col("body"))}).drop("content_type")
    texts = extract_log_text(split, "body", name)
    return texts.withColumn(name, F.coalesce("_plain", column(name))).drop("_plain")


def explode_task_instances(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per task-instance object of a payload, as JSON, numbered from 0."""
    others = [column(c) for c in df.columns if c != payload]
    named = df.select(*others, column(payload).alias("_payload"))
    found = P.with_task_instances(named, "_payload", "_items").drop("_payload")
    # The outer form, as for the other Spark would evaluate the items twice, for a filter on them.
    items = found.select(*others, F.posexplode_outer("_items").alias("item_no", "task_instance"))
    return items.filter(F.col("item_no").isNotNull())


def unreadable_payloads(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows whose payload begins like JSON but is none, for a quarantine: they hold no task instances and no
    address, and count as plain text where the log's text is wanted."""
    others = [column(c) for c in df.columns if c != payload]
    named = df.select(*others, column(payload).alias("_payload"))
    return named.filter(P.is_unreadable("_payload")).withColumnRenamed("_payload", payload)


def fingerprint_text(df: DataFrame, content: str = "content") -> DataFrame:
    """Add ``content_hash``, ``content_size_bytes`` and ``line_count`` of a text column."""
    return df.select(
        "*", X.sha256_hex(column(content)).alias("content_hash"),
        F.octet_length(column(content)).cast("bigint").alias("content_size_bytes"),
        X.line_count(column(content)).alias("line_count"))


def normalize_json_source(df: DataFrame, raw_json: str = "raw_json") -> DataFrame:
    """Replace a JSON column by its canonical text and add its hash and size."""
    return P.with_canonical_json(df, raw_json).select(
        "*", X.sha256_hex(column(raw_json)).alias("content_hash"),
        F.octet_length(column(raw_json)).cast("bigint").alias("content_size_bytes"))


def route_sources(df: DataFrame) -> DataFrame:
    """Turn ``raw_text, raw_content, raw_json`` into a text or a JSON source.

    A row with any text is a text source, also an empty one; every other row is a JSON source,
    with NULL as ``{}``. Both kinds come out of one scan.
    """
    is_text = F.col("raw_text").isNotNull() | F.col("raw_content").isNotNull()
    others = [column(c) for c in df.columns if c not in ("raw_text", "raw_content", "raw_json")]
    routed = P.with_canonical_json(df, "raw_json", ~is_text).select(
        *others,
        F.when(is_text, F.lit("TEXT")).otherwise(F.lit("JSON")).alias("content_type"),
        F.when(is_text, X.pick_content(F.col("raw_text"), F.col("raw_content"))).alias("raw_content"),
        "raw_json")
    body = F.coalesce("raw_content", "raw_json")
    return routed.select(
        "*", X.sha256_hex(body).alias("content_hash"),
        F.octet_length(body).cast("bigint").alias("content_size_bytes"),
        X.line_count(F.col("raw_content")).alias("line_count"))


def invalid_categories(df: DataFrame, name: str, allowed: list[str]) -> DataFrame:
    """Rows whose category is not an allowed one; NULL is."""
    return df.filter(~column(name).isin(allowed))


def require_allowed(df: DataFrame, name: str, allowed: list[str]) -> DataFrame:
    """``df`` unchanged, failing when a row with an unknown category is computed."""
    message = F.concat(F.lit(f"unknown {name}: "), column(name))
    checked = (F.when(column(name).isNull() | column(name).isin(allowed), column(name))
                .otherwise(F.raise_error(message).cast("string")))
    return df.withColumn(name, checked)


def normalize_attempt(df: DataFrame) -> DataFrame:
    """``try_number`` of at least 1, integer ``map_index``, and whether the task is mapped."""
    map_index = F.col("map_index").cast("int")
    return (df.withColumn("try_number", F.greatest(F.lit(1), F.col("try_number").cast("int")))
              .withColumn("map_index", map_index)
              .withColumn("is_mapped", F.coalesce(F.col("map_index") >= 0, F.lit(False))))


Allowed = dict[str, list[str]]


def split_allowed(df: DataFrame, allowed: Allowed) -> tuple[DataFrame, DataFrame]:
    """Rows with allowed categories only, and the others with the names of the offending columns in
    ``quarantined_for``. NULL is allowed. Columns that ``df`` lacks fail."""
    bad = [F.when(F.coalesce(~column(c).isin(values), F.lit(False)), F.lit(c)) for c, values in allowed.items()]
    marked = df.withColumn("quarantined_for", F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>"))
    none = F.size("quarantined_for") == 0
    return marked.filter(none).drop("quarantined_for"), marked.filter(~none)


def _checked(df: DataFrame, allowed: Allowed | None) -> DataFrame:
    for name, values in (allowed or {}).items():
        df = require_allowed(df, name, values)
    return df


def upsert_log_sources(base: DataFrame, incoming: DataFrame, now: Column | None = None,
                       allowed: Allowed | None = None) -> DataFrame:
    """Apply routed sources (see ``route_sources``) to the table of sources; a category beyond ``allowed`` fails."""
    stamped = (_checked(incoming, allowed).withColumn("id", source_id())
               .withColumn("collected_at", F.current_timestamp() if now is None else now))
    return upsert(base, stamped, LOG_SOURCE_RULE)


def upsert_resources(base: DataFrame, incoming: DataFrame, now: Column | None = None,
                     allowed: Allowed | None = None) -> DataFrame:
    """Apply discovered resources to the table of resources; a category beyond ``allowed`` fails."""
    stamped = (P.with_canonical_json(_checked(incoming, allowed), "raw_payload")
               .withColumn("updated_at", F.current_timestamp() if now is None else now))
    return upsert(base, stamped, RESOURCE_RULE)


def annotate_chunks(chunks: DataFrame) -> DataFrame:
    """Add hash, level, error flag and error hint of ``message``."""
    message = F.col("message")
    return (chunks.withColumns({"message_hash": X.sha256_hex(message),
                                "level": X.guess_level(message),
                                "is_error": X.is_error(message)})
                  .withColumn("error_hint", X.error_hint(F.col("is_error"))))


def chunk_sources(sources: DataFrame, max_lines: int = MAX_LINES,
                  max_chars: int = MAX_CHARS) -> DataFrame:
    """Annotated chunks of text sources."""
    texts = sources.select(F.col("id").alias("log_source_id"), "pipeline_run_id",
                           "pipeline_task_run_id", "source_type", "raw_content")
    return annotate_chunks(chunk_text(texts, "raw_content", max_lines, max_chars))


def replace_chunks(base: DataFrame, incoming: DataFrame, seq: str | None = None) -> DataFrame:
    """The table of chunks with those of every source in ``incoming`` replaced.

    A source without new chunks is not in ``incoming`` and keeps its old ones. With ``seq`` a
    chunk given more than once takes its last version; without, chunks are given once.

    The replaced sources are stored, one row each: if few they are broadcast, by their real size,
    and else Spark can split a source that holds much of ``base`` between tasks. It does that
    only for joins whose sides come straight from a shuffle, not out of an aggregation.
    """
    key = ["log_source_id", "chunk_index"]
    if seq is not None:
        rest = [c for c in incoming.columns if c not in key]
        incoming = (incoming.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_last"))
                            .select(*key, "_last.*").drop(seq))
    replaced = materialize(incoming.select("log_source_id").distinct(), "replaced")
    return base.join(replaced, "log_source_id", "left_anti").unionByName(incoming)


def affected_rows(incoming: DataFrame) -> DataFrame:
    """Chunks written per source."""
    return incoming.groupBy("log_source_id").agg(F.count(F.lit(1)).alias("affected_rows"))


