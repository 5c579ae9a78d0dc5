"""Registered queries: pipeline status events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brontide.catalog.common import Registry, table
from brontide.operators import events as E
from brontide.session import work_dir
from brontide.streaming import events as S

registry = Registry()

# Status events made of the events table: one dag per event type, twenty runs each.
_EVENT = {
    "dag_id": "event_type",
    "dag_run_id": "cast(user_id % 20 as varchar(20))",
    "task_id": "case when event_id % 7 = 0 then null else concat('t', cast(event_id % 3 as varchar(20))) end",
    "status": """case when event_type <> 'error' then 'success' when event_id % 7 = 0 then 'failed'
                 when event_id % 2 = 0 then 'failed' else 'retry' end""",
    "scope": "case when event_id % 7 = 0 then 'dag' else 'task' end",
    "try_number": "case when event_id % 7 = 0 then null else cast(event_id % 2 as int) + 1 end",
    "event_id": "event_id",
    "callback_ts": "ts",
}
EVENTS_SQL = f"select {', '.join(f'{e} as {c}' for c, e in _EVENT.items())} from events"
_KEY_SQL = """concat(dag_id, ':', dag_run_id, ':', coalesce(task_id, 'None'), ':', status, ':',
    coalesce(cast(try_number as varchar(20)), 'None'))"""
_ORDER = ["callback_ts", "event_id"]


def status_events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} as {c}" for c, e in _EVENT.items()])


def _callbacks(spark, sf_dir, *more: str) -> DataFrame:
    """Raw callbacks of the same events, with more columns of theirs."""
    iso = F.date_format("callback_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    hook = F.concat(F.lit("on_"), "scope", F.lit("_"), F.when(F.col("status") == "failed", "failure")
                    .otherwise(F.col("status")))
    no_run = F.col("event_id") % 11 == 0
    return status_events(spark, sf_dir).select(
        hook.alias("hook"),
        F.when(~no_run, F.struct(
            F.col("dag_id"), F.col("dag_run_id").alias("run_id"),
            F.when(F.col("status") == "success", "running").otherwise("").alias("state"),
            iso.alias("start_date"), F.lit(None).cast("string").alias("end_date"),
            F.lit("").alias("logical_date"))).alias("dag_run"),
        F.struct(F.concat(F.lit("d_"), "dag_id").alias("dag_id")).alias("dag"),
        F.when(F.col("task_id").isNotNull(), F.struct(
            F.col("task_id"), F.col("status").alias("state"), iso.alias("start_date"),
            F.lit(None).cast("string").alias("end_date"), F.col("try_number"),
            F.lit(3).alias("max_tries"))).alias("task_instance"),
        F.when(F.col("status") == "success", "").otherwise(F.col("dag_id")).alias("exception"),
        iso.alias("callback_ts"), *more)


@registry.add(f"""select 'AIRFLOW_CALLBACK' as event_type, case when event_id % 11 = 0 then 'd_' || dag_id else dag_id end as dag_id,
    case when event_id % 11 <> 0 then dag_run_id end as dag_run_id, task_id,
    case when event_id % 11 <> 0 and status = 'success' then 'running' end as dag_state,
    case when task_id is not null then status end as task_state,
    case when event_id % 11 <> 0 then callback_ts end as dag_start, cast(null as timestamp) as dag_end,
    case when task_id is not null then callback_ts end as task_start, cast(null as timestamp) as task_end,
    cast(null as timestamp) as logical_date, case when status <> 'success' then {_EVENT['dag_id']} end as exception,
    try_number, case when task_id is not null then 3 end as max_tries, callback_ts, status, scope
    from ({EVENTS_SQL.replace('event_id as event_id', 'event_id as event_id, event_type')})""")
def normalize_events(spark, sf_dir):
    events = E.normalize_events(_callbacks(spark, sf_dir))
    times = ["dag_start", "dag_end", "task_start", "task_end", "logical_date", "callback_ts"]
    return events.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


@registry.add("""select field, case field when 'callback_ts' then count(*) filter (where event_id % 13 = 0)
    when 'dag_run.end_date' then count(*) filter (where event_id % 17 = 0 and event_id % 11 <> 0) else 0 end as unreadable
    from events, (values ('dag_run.start_date'), ('dag_run.end_date'), ('task_instance.start_date'), ('task_instance.end_date'),
                         ('dag_run.logical_date'), ('callback_ts')) f(field) group by field""")
def unreadable_times(spark, sf_dir):
    """Callbacks of which some tell no readable time."""
    events = _callbacks(spark, sf_dir, "event_id")
    run = F.col("dag_run").withField("end_date", F.when(F.col("event_id") % 17 == 0, F.lit("yesterday")))
    return E.unreadable_times(events.withColumns({
        "dag_run": run, "callback_ts": F.when(F.col("event_id") % 13 == 0, F.lit("31.12.")).otherwise(F.col("callback_ts"))}))


@registry.add(f"select event_id, {_KEY_SQL} as idempotency_key from ({EVENTS_SQL})")
def idempotency_key(spark, sf_dir):
    return status_events(spark, sf_dir).select(
        "event_id", E.idempotency_key().alias("idempotency_key"))


_DEDUP_SQL = f"""select * exclude (_rn) from (select *, {_KEY_SQL} as idempotency_key,
    row_number() over (partition by {_KEY_SQL} order by callback_ts, event_id) as _rn from ({EVENTS_SQL})) where _rn = 1"""


@registry.add(_DEDUP_SQL)
def dedup_events(spark, sf_dir):
    return E.dedup_events(status_events(spark, sf_dir), _ORDER)


_STATE_SQL = f"""select dag_id, dag_run_id, arg_max(status, o) as status,
    arg_max(task_id, o) filter (where task_id is not null) as latest_task_id,
    arg_max(task_id, o) filter (where task_id is not null and status = 'failed' and scope = 'task') as failed_task_id
    from (select *, row_number() over (order by callback_ts, event_id) as o from ({EVENTS_SQL})) group by 1, 2"""


@registry.add(_STATE_SQL)
def run_state(spark, sf_dir):
    return E.run_state(status_events(spark, sf_dir), _ORDER)


@registry.add(f"""select *, true as collect_logs, status = 'failed' and scope = 'task' as escalate
    from ({_DEDUP_SQL}) where status in ('retry', 'failed')""")
def select_followups(spark, sf_dir):
    return E.select_followups(E.dedup_events(status_events(spark, sf_dir), _ORDER))


# --- streams --------------------------------------------------------------------------------

def _event_stream(spark, sf_dir) -> DataFrame:
    """The events table as a file stream."""
    source = f"{sf_dir}/events.parquet"
    rows = (spark.readStream.schema(spark.read.parquet(source).schema)
                 .option("pathGlobFilter", "events.parquet").parquet(sf_dir))
    events = rows.selectExpr(*[f"{e} as {c}" for c, e in _EVENT.items()])
    return events.withColumn("callback_ts", F.col("callback_ts").cast("timestamp"))


@registry.add(f"select distinct {_KEY_SQL} as idempotency_key, dag_id, status from ({EVENTS_SQL})")
def stream_dedup_events(spark, sf_dir):
    """Three runs of one stream, the latest events first and the oldest last."""
    path = work_dir(spark, "stream")
    events = status_events(spark, sf_dir).withColumn("callback_ts", F.col("callback_ts").cast("timestamp"))
    day = F.dayofmonth("callback_ts")
    for part in (day > 20, day.between(11, 20), day <= 10):
        events.filter(part).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{path}/in")
        S.write_stream(S.dedup_event_stream(stream), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("idempotency_key", "dag_id", "status")


@registry.add(f"""select idempotency_key, dag_id, status, event_id, min(batch) over (partition by idempotency_key) as batch from (
    select *, {_KEY_SQL} as idempotency_key, case when day(callback_ts) <= 10 then 0 when day(callback_ts) <= 20 then 1 else 2 end as batch
    from ({EVENTS_SQL}))
    qualify row_number() over (partition by idempotency_key order by batch, callback_ts, event_id) = 1""")
def stream_dedup_for_good(spark, sf_dir):
    """Three runs of one stream; the third brings all events of the first again, and of those before the first none is new."""
    path = work_dir(spark, "stream")
    events = status_events(spark, sf_dir).withColumn("callback_ts", F.col("callback_ts").cast("timestamp"))
    day = F.dayofmonth("callback_ts")
    for part in (events.filter(day <= 10), events.filter(day.between(11, 20)), events.filter((day > 20) | (day <= 10))):
        part.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{path}/in")
        S.dedup_for_good(stream, f"{path}/out", f"{path}/ledger", f"{path}/checkpoint", _ORDER).awaitTermination()
    return S.read_admitted(spark, f"{path}/out").select("idempotency_key", "dag_id", "status", "event_id", "batch")


@registry.add(f"""select distinct {_KEY_SQL} as idempotency_key, dag_id, status, true as collect_logs
    from ({EVENTS_SQL}) where status in ('retry', 'failed')""")
def stream_followups(spark, sf_dir):
    """First arrivals that call for log collection, as they come in."""
    path = work_dir(spark, "stream")
    found = E.select_followups(S.dedup_event_stream(_event_stream(spark, sf_dir)))
    S.write_stream(found, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("idempotency_key", "dag_id", "status", "collect_logs")


@registry.add(_STATE_SQL)
def stream_run_state(spark, sf_dir):
    path = work_dir(spark, "stream")
    query = S.maintain_run_state(_event_stream(spark, sf_dir), f"{path}/state",
                                 f"{path}/checkpoint", _ORDER)
    query.awaitTermination()
    return S.read_run_state(spark, f"{path}/state")
