import json

import pytest
from pyspark.sql import functions as F

from brontide.operators import events as E
from brontide.schemas import CALLBACK
from brontide.session import work_dir
from brontide.streaming import events as S

RUN = {"dag_id": "d", "run_id": "r", "state": "running", "start_date": "2024-01-01T00:00:00+00:00",
       "end_date": None, "logical_date": ""}
TASK = {"task_id": "t", "state": "failed", "start_date": "2024-01-01T02:00:00+02:00", "end_date": None,
        "try_number": 2, "max_tries": 2}


def callbacks(*rows):
    full = [{"dag_run": RUN, "dag": {"dag_id": "other"}, "task_instance": TASK, "exception": "boom",
             "callback_ts": "2024-01-01T00:00:01.5+00:00", **row} for row in rows]
    return [json.dumps(r) for r in full]


def read(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "j string").select(
        F.from_json("j", CALLBACK).alias("c")).select("c.*")


@pytest.mark.parametrize("hook, status, scope", [
    ("on_dag_success", "success", "dag"), ("on_dag_failure", "failed", "dag"),
    ("on_task_success", "success", "task"), ("on_task_failure", "failed", "task"),
    ("on_task_retry", "retry", "task")])
def test_hooks(spark, hook, status, scope):
    row = E.normalize_events(read(spark, callbacks({"hook": hook}))).first()
    assert (row["status"], row["scope"], row["dag_id"], row["event_type"]) == (
        status, scope, "d", "AIRFLOW_CALLBACK")
    assert row["task_start"] == row["dag_start"] and row["logical_date"] is None


def test_missing_parts(spark):
    row = E.normalize_events(read(spark, callbacks(
        {"hook": "on_dag_failure", "dag_run": None, "task_instance": None, "exception": ""}))).first()
    assert (row["dag_id"], row["dag_run_id"], row["task_id"], row["exception"], row["dag_state"],
            row["try_number"]) == ("other", None, None, None, None, None)


def test_idempotency_key(spark):
    rows = callbacks({"hook": "on_task_retry"}, {"hook": "on_dag_failure", "task_instance": None})
    keys = E.normalize_events(read(spark, rows)).select(E.idempotency_key().alias("k")).collect()
    assert [r["k"] for r in keys] == ["d:r:t:retry:2", "d:r:None:failed:None"]


def test_replays_change_nothing(spark):
    events = E.normalize_events(read(spark, callbacks(
        {"hook": "on_task_retry"}, {"hook": "on_task_failure"}, {"hook": "on_dag_success"})))
    once = sorted(map(str, E.dedup_events(events, ["callback_ts"]).collect()))
    twice = sorted(map(str, E.dedup_events(events.union(events), ["callback_ts"]).collect()))
    assert once == twice and len(once) == 3


def test_failing_task_story(spark):
    """A retry, the failure of the task, then that of its run."""
    at = "2024-01-01T00:00:0{}+00:00".format
    events = E.normalize_events(read(spark, callbacks(
        {"hook": "on_task_retry", "callback_ts": at(1), "task_instance": {**TASK, "try_number": 1}},
        {"hook": "on_task_failure", "callback_ts": at(2)},
        {"hook": "on_dag_failure", "callback_ts": at(3)})))
    state = E.run_state(events, ["callback_ts"]).first()
    assert tuple(state) == ("d", "r", "failed", "t", "t")
    unique = E.dedup_events(events, ["callback_ts"])
    assert unique.count() == 2  # the failure of the run repeats the key of the task's
    follow = {r["status"]: r["escalate"] for r in E.select_followups(unique).collect()}
    assert follow == {"retry": False, "failed": True}


def test_partial_states_merge_in_any_order(spark):
    rows = [("d", "r", f"t{i}", "failed" if i == 2 else "success", "task", i) for i in range(6)]
    events = spark.createDataFrame(rows, "dag_id string, dag_run_id string, task_id string, "
                                         "status string, scope string, at int")
    parts = [E.partial_run_state(events.filter(F.col("at") % 3 == k), ["at"]) for k in (2, 0, 1)]
    merged = E.merge_run_state(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[0]))
    assert tuple(merged.first()) == tuple(E.run_state(events, ["at"]).first()) == ("d", "r", "success", "t5", "t2")


@pytest.mark.parametrize("fold_every", [1, 2, 100])
def test_stream_in_two_runs(spark, fold_every):
    """Two runs with one checkpoint equal one batch; replays in the second run are dropped."""
    path = work_dir(spark, "test-stream")
    first = callbacks({"hook": "on_task_retry"}, {"hook": "on_task_retry"})
    second = callbacks({"hook": "on_task_retry"}, {"hook": "on_task_failure"})
    states = []
    for lines in (first, second):
        (spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
              .write.mode("append").text(f"{path}/in"))
        events = S.read_callbacks(spark, f"{path}/in")
        S.write_stream(S.dedup_event_stream(events), f"{path}/out", f"{path}/ck").awaitTermination()
        S.maintain_run_state(events, f"{path}/state", f"{path}/ck2", ["callback_ts"],
                             fold_every=fold_every).awaitTermination()
        states.append(S.read_run_state(spark, f"{path}/state").first()["failed_task_id"])
    keys = [r["idempotency_key"] for r in spark.read.parquet(f"{path}/out").collect()]
    assert sorted(keys) == ["d:r:t:failed:2", "d:r:t:retry:2"]
    assert states == [None, "t"]


def test_clocks_do_not_decide(spark):
    """Events from the future and from long ago are first arrivals like any; a replay still goes."""
    path = work_dir(spark, "test-stream")
    for i, at in enumerate(["2024-01-30", "2099-01-01", "2024-02-10", "2001-01-01", "2024-01-30"]):
        event = callbacks({"hook": "on_task_retry", "callback_ts": f"{at}T00:00:00+00:00",
                           "task_instance": {**TASK, "task_id": f"t{i % 4}"}})
        spark.createDataFrame([(x,) for x in event], "value string").coalesce(1).write.mode("append").text(f"{path}/in")
        events = S.read_callbacks(spark, f"{path}/in")
        S.write_stream(S.dedup_event_stream(events), f"{path}/out", f"{path}/ck").awaitTermination()
    found = spark.read.parquet(f"{path}/out").select("task_id").collect()
    assert sorted(r["task_id"] for r in found) == ["t0", "t1", "t2", "t3"]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """One key is most of the stream; the stateful operator sees few of its rows."""
    path = work_dir(spark, "test-stream")
    rows = spark.range(0, 30_000, numPartitions=4).selectExpr(
        "'d' as dag_id", "'r' as dag_run_id",
        "case when id % 10 > 0 then 'hot' else concat('t', id) end as task_id", "'retry' as status",
        "'task' as scope", "1 as try_number", "timestamp_seconds(1704067200 + id) as callback_ts")
    rows.write.parquet(f"{path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
    query = S.write_stream(S.dedup_event_stream(stream), f"{path}/out", f"{path}/ck")
    query.awaitTermination()
    assert spark.read.parquet(f"{path}/out").count() == 3_001
    states = [p["stateOperators"][0] for p in query.recentProgress]
    assert states[-1]["numRowsTotal"] == 3_001
    assert sum(s["customMetrics"]["numDroppedDuplicateRows"] for s in states) < 100
