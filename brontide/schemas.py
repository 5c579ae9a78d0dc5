"""Declared schemas of the documents and tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
}


def _struct(**fields) -> T.StructType:
    """Nullable fields; a type is one of the names above or a type object."""
    return T.StructType([T.StructField(name, _TYPES[kind] if isinstance(kind, str) else kind)
                         for name, kind in fields.items()])


def _strings(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "string")


# One document per exported table.
TABLE_METADATA = _struct(
    table="string",
    columns=T.ArrayType(_struct(cid="int", name="string", type="string", notnull="int",
                                dflt_value="string", pk="int")),
    primary_keys=T.ArrayType(T.StringType()),
    foreign_keys=T.ArrayType(_struct(id="int", seq="int", **_strings("table", "from", "to"))),
    row_count="bigint", csv_path="string")

DQ_REPORT = _struct(
    table="string", source_rows="bigint", cleansed_rows="bigint",
    duplicate_rows_removed="bigint", primary_keys=T.ArrayType(T.StringType()),
    source_path="string", target_path="string")

# A report row with the outcome of the whole chain.
INGEST_REPORT = T.StructType([*DQ_REPORT, *_struct(target_rows="bigint", **_strings("status", "reason"))])

# A publication of one part of the tables under a root.
MANIFEST = _struct(part="bigint", run="string", version="bigint", upto="bigint")

LOG_SOURCE = _struct(
    id="string", pipeline_run_id="bigint", pipeline_task_run_id="bigint",
    **_strings("source_type", "content_type", "source_uri", "dag_id", "dag_run_id", "task_id"),
    try_number="int", map_index="int",
    **_strings("resource_type", "resource_id", "raw_content", "raw_json", "content_hash"),
    content_size_bytes="bigint", line_count="int", collected_at="timestamp")

LOG_CHUNK = _struct(
    log_source_id="string", pipeline_run_id="bigint", pipeline_task_run_id="bigint",
    source_type="string", chunk_index="bigint", line_start="bigint", line_end="bigint",
    char_start="bigint", char_end="bigint", message="string", message_hash="string",
    level="string", is_error="boolean", error_hint="string")

RESOURCE = _struct(
    pipeline_run_id="bigint", pipeline_task_run_id="bigint",
    **_strings("resource_type", "resource_id", "resource_name", "parent_resource_type",
               "parent_resource_id", "discovered_from", "confidence", "namespace",
               "cluster_name", "application_id"),
    started_at="timestamp", finished_at="timestamp", duration_sec="double",
    raw_payload="string", updated_at="timestamp")

# A raw callback as the orchestrator hands it over: the hook that fired and its context.
CALLBACK = _struct(
    hook="string",
    dag_run=_struct(**_strings("dag_id", "run_id", "state", "start_date", "end_date",
                               "logical_date")),
    dag=_struct(dag_id="string"),
    task_instance=_struct(**_strings("task_id", "state", "start_date", "end_date"),
                          try_number="int", max_tries="int"),
    exception="string", callback_ts="string")

EVENT = _struct(
    **_strings("event_type", "dag_id", "dag_run_id", "task_id", "dag_state", "task_state"),
    dag_start="timestamp", dag_end="timestamp", task_start="timestamp", task_end="timestamp",
    logical_date="timestamp", exception="string", try_number="int", max_tries="int",
    callback_ts="timestamp", status="string", scope="string")

CONTAINER_LINE = _struct(ts="timestamp", **_strings("container_name", "image", "line"))

# A container line with its labels, as it is filed.
TAILED = _struct(ts="timestamp", **_strings("container", "image", "line", "service"))
