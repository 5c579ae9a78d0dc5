"""Pipeline status events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brontide.operators.project import column
from brontide.schemas import EVENT

# Fixed values ------------------------------------------------------------------------------
EVENT_TYPE = "AIRFLOW_CALLBACK"
# Callback hook -> (status, scope).
HOOKS = {
    "on_dag_success": ("success", "dag"),
    "on_dag_failure": ("failed", "dag"),
    "on_task_success": ("success", "task"),
    "on_task_failure": ("failed", "task"),
    "on_task_retry": ("retry", "task"),
}
# -------------------------------------------------------------------------------------------


def _non_empty(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def normalize_events(callbacks: DataFrame) -> DataFrame:
    """Status events from raw callbacks (schema ``CALLBACK``); works on streams too."""
    def time(field: str) -> Column:
        return F.try_to_timestamp(_non_empty(F.col(field)))

    def by_hook(part: int) -> Column:
        return F.coalesce(*[F.when(F.col("hook") == hook, F.lit(values[part]))
                            for hook, values in HOOKS.items()])

    run = F.col("dag_run")
    columns = {
        "event_type": F.lit(EVENT_TYPE),
        # The run names its dag; without a run the dag does.
        "dag_id": F.when(run.isNotNull(), run["dag_id"]).otherwise(F.col("dag.dag_id")),
        "dag_run_id": run["run_id"],
        "task_id": F.col("task_instance.task_id"),
        "dag_state": _non_empty(run["state"]),
        "task_state": _non_empty(F.col("task_instance.state")),
        "dag_start": time("dag_run.start_date"),
        "dag_end": time("dag_run.end_date"),
        "task_start": time("task_instance.start_date"),
        "task_end": time("task_instance.end_date"),
        "logical_date": time("dag_run.logical_date"),
        "exception": _non_empty(F.col("exception")),
        "try_number": F.col("task_instance.try_number"),
        "max_tries": F.col("task_instance.max_tries"),
        "callback_ts": time("callback_ts"),
        "status": by_hook(0),
        "scope": by_hook(1),
    }
    return callbacks.select(*[columns[name].alias(name) for name in EVENT.names])


# Fields of a callback that hold a time as text.
_TIMES = ("dag_run.start_date", "dag_run.end_date", "task_instance.start_date", "task_instance.end_date",
          "dag_run.logical_date", "callback_ts")


def unreadable_times(callbacks: DataFrame) -> DataFrame:
    """``field, unreadable``: how many non-empty times of each field ``normalize_events`` turns into NULL."""
    def bad(field: str) -> Column:
        text = _non_empty(F.col(field))
        return F.count_if(text.isNotNull() & F.try_to_timestamp(text).isNull())

    counts = callbacks.agg(*[bad(f).alias(f"n{i}") for i, f in enumerate(_TIMES)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"n{i}").alias("unreadable"))
                                            for i, f in enumerate(_TIMES)])))


def idempotency_key() -> Column:
    """``dag:run:task:status:try`` with NULL as ``None``; the scope is not part of it."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("None"))
             for c in ("dag_id", "dag_run_id", "task_id", "status", "try_number")]
    return F.concat(*[p for part in parts for p in (F.lit(":"), part)][1:])


def dedup_events(events: DataFrame, order_by: list[str]) -> DataFrame:
    """The first event of every idempotency key; ``order_by`` should leave no ties.

    Aggregated before the shuffle, so replays of one key meet as one row per map task.
    """
    whole = F.struct(*[column(c) for c in events.columns])
    first = (events.groupBy(idempotency_key().alias("idempotency_key"))
                   .agg(F.min_by(whole, F.struct(*[column(c) for c in order_by])).alias("_first")))
    return first.select("idempotency_key", "_first.*")


def partial_run_state(events: DataFrame, order_by: list[str]) -> DataFrame:
    """Per run the last status, task and failed task among ``events``, each with its place in
    the order, so that the states of several batches can be merged."""
    order = F.struct(*[column(c) for c in order_by])
    has_task = F.col("task_id").isNotNull()
    failed_task = has_task & (F.col("status") == "failed") & (F.col("scope") == "task")
    latest = {"status": order, "latest_task_id": F.when(has_task, order),
              "failed_task_id": F.when(failed_task, order)}
    return events.groupBy("dag_id", "dag_run_id").agg(*[
        F.max(F.when(at.isNotNull(),
                     F.struct(at.alias("at"), F.col("status" if name == "status" else "task_id")
                              .alias("value")))).alias(name)
        for name, at in latest.items()])


_STATE = ("status", "latest_task_id", "failed_task_id")


def merge_partial_states(partials: DataFrame) -> DataFrame:
    """One partial state per run; applying one twice changes nothing."""
    return partials.groupBy("dag_id", "dag_run_id").agg(*[F.max(c).alias(c) for c in _STATE])


def merge_run_state(partials: DataFrame) -> DataFrame:
    """State per run from partial states."""
    return merge_partial_states(partials).select(
        "dag_id", "dag_run_id", *[F.col(f"{c}.value").alias(c) for c in _STATE])


def run_state(events: DataFrame, order_by: list[str]) -> DataFrame:
    """Per run the last status, the last task and the last task that failed for good."""
    return merge_run_state(partial_run_state(events, order_by))


def select_followups(events: DataFrame) -> DataFrame:
    """Events that call for log collection, and whether they escalate.

    Retries and failures have their logs collected; a task that failed for good escalates.
    """
    followed = events.filter(F.col("status").isin("retry", "failed"))
    return followed.select(
        "*", F.lit(True).alias("collect_logs"),
        ((F.col("status") == "failed") & (F.col("scope") == "task")).alias("escalate"))
