"""Upserts against their sequential application."""

import json
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from brontide.operators import logs as L
from brontide.operators.upsert import UpsertRule, upsert
from brontide.plans import collect
from brontide.schemas import LOG_SOURCE, RESOURCE
from brontide.session import work_dir
from brontide.sources import commits, files, levels, parts, tables

RULE = UpsertRule(key={"r": None, "t": 0, "m": -1}, keep=("r",), fill=("t", "name"),
                  overwrite=("m", "body"))
SCHEMA = "r int, t int, name string, m int, body string"


def random_rows(rnd, n):
    return [(rnd.choice([1, 1, 1, 2, 3]), rnd.choice([None, 0, 1]), rnd.choice([None, "a", "b", "c"]),
             rnd.choice([None, -1, 5]), rnd.choice([None, "x", "y", "z"])) for _ in range(n)]


def sequential(state: dict, rows) -> dict:
    for r, t, name, m, body in rows:
        key = (r, t or 0, -1 if m is None else m)
        old = state.get(key)
        if old:
            t, name = (old[1] if t is None else t), (old[2] if name is None else name)
        state[key] = (r, t, name, m, body)
    return state


@pytest.mark.parametrize("seed", range(3))
def test_upsert_equals_sequential_application(spark, seed):
    rnd = random.Random(seed)
    state, base = {}, spark.createDataFrame([], SCHEMA)
    for size in (60, 1, 40):
        rows = random_rows(rnd, size)
        state = sequential(state, rows)
        batch = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], SCHEMA + ", seq int")
        base = upsert(base, batch, RULE).select("r", "t", "name", "m", "body")
    assert sorted(map(tuple, base.collect()), key=str) == sorted(state.values(), key=str)


def test_null_in_the_order_fails(spark):
    batch = spark.createDataFrame([(1, 0, "a", 0, "x", 1), (1, 0, "b", 0, "y", None)], SCHEMA + ", seq int")
    with pytest.raises(Exception, match="NULL in seq"):
        upsert(spark.createDataFrame([], SCHEMA), batch, RULE).collect()


def source(spark, seq=0, **values):
    row = {**dict.fromkeys(LOG_SOURCE.names), "pipeline_run_id": 1, "source_type": "AIRFLOW_LOG",
           "raw_text": None, "seq": seq, **values}
    names = [c for c in LOG_SOURCE.names if c not in (
        "id", "content_type", "content_hash", "content_size_bytes", "line_count", "collected_at")]
    types = {f.name: f.dataType.simpleString() for f in LOG_SOURCE}
    schema = ", ".join([f"{c} {types[c]}" for c in names] + ["raw_text string", "seq int"])
    return spark.createDataFrame([tuple(row[c] for c in [*names, "raw_text", "seq"])], schema)


def test_text_and_json_replace_each_other(spark):
    base = spark.createDataFrame([], LOG_SOURCE)
    text = L.route_sources(source(spark, raw_text="a\nb", task_id="", try_number=0, dag_id="d"))
    base = L.upsert_log_sources(base, text)
    first = base.first()
    assert (first["content_type"], first["raw_content"], first["line_count"]) == ("TEXT", "a\nb", 2)
    # NULL and '' or 0 are the same key; the spelling stays as it was, dag_id is overwritten.
    json = L.route_sources(source(spark, raw_json='{"b":1, "a":2}', pipeline_task_run_id=0))
    rows = L.upsert_log_sources(base, json).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["id"], row["content_type"], row["raw_content"], row["raw_json"], row["line_count"]) == (
        first["id"], "JSON", None, '{"a":2,"b":1}', None)
    assert (row["task_id"], row["try_number"], row["dag_id"], row["pipeline_task_run_id"]) == ("", 0, None, 0)


def test_source_ids(spark):
    ids = [source(spark, **v).select(L.source_id().alias("id")).first()["id"]
           for v in ({}, {"task_id": ""}, {"try_number": 0}, {"map_index": -1}, {"map_index": 0},
                     {"task_id": "0"}, {"resource_id": "0"})]
    assert len(set(ids[:4])) == 1 and len(set(ids[3:])) == 4


def resource(spark, **values):
    row = {**dict.fromkeys(RESOURCE.names), "pipeline_run_id": 1, "resource_type": "SPARK",
           "resource_id": "r", "discovered_from": "AIRFLOW_LOG", "confidence": "high", "seq": 0, **values}
    names = [f for f in RESOURCE if f.name != "updated_at"]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in names] + ["seq int"])
    return spark.createDataFrame([tuple(row[f.name] for f in names) + (row["seq"],)], schema)


def test_resources_fill_but_do_not_erase(spark):
    base = L.upsert_resources(spark.createDataFrame([], RESOURCE),
                              resource(spark, resource_name="n", raw_payload='{"a":1}', duration_sec=1.5))
    row = L.upsert_resources(base, resource(spark, namespace="ns", confidence="low")).collect()
    assert len(row) == 1
    assert (row[0]["resource_name"], row[0]["namespace"], row[0]["duration_sec"], row[0]["confidence"],
            row[0]["raw_payload"]) == ("n", "ns", 1.5, "low", "{}")


def test_replace_chunks(spark):
    schema = "log_source_id string, chunk_index bigint, message string"
    base = spark.createDataFrame([("a", 0, "a0"), ("a", 1, "a1"), ("b", 0, "b0")], schema)
    new = spark.createDataFrame([("a", 0, "x", 1), ("a", 0, "y", 2), ("c", 0, "c0", 3)], schema + ", seq int")
    rows = L.replace_chunks(base, new, "seq").collect()
    assert sorted(map(tuple, rows)) == [("a", 0, "y"), ("b", 0, "b0"), ("c", 0, "c0")]
    assert {r["log_source_id"]: r["affected_rows"] for r in L.affected_rows(new).collect()} == {"a": 2, "c": 1}


def test_empty_text_keeps_old_chunks(spark):
    base = work_dir(spark, "test-corpus")
    assert collect.append_logs(source(spark, raw_text="ERROR one\n\ntwo"), base, 0, max_lines=1) == {
        "log_sources": 1, "log_chunks": 2}
    for batch, text in ((1, ""), (2, " \n ")):
        assert collect.append_logs(source(spark, raw_text=text), base, batch) == {
            "log_sources": 1, "log_chunks": 0}
    assert [r["raw_content"] for r in collect.current_sources(spark, base).collect()] == [" \n "]
    chunks = sorted(collect.current_chunks(spark, base).collect(), key=lambda r: r["chunk_index"])
    assert [(c["message"], c["line_start"], c["level"], c["is_error"], c["error_hint"]) for c in chunks] == [
        ("ERROR one", 1, "ERROR", True, "possible_error_chunk"), ("two", 3, None, False, None)]
    collect.append_logs(source(spark, raw_text="three"), base, 3)
    target = work_dir(spark, "test-published")
    assert collect.publish_logs(spark, base, target) == {"log_sources": 1, "log_chunks": 1}
    assert collect.published(spark, target, "log_chunks").first()["message"] == "three"


def test_batch_written_again_changes_nothing(spark):
    base = work_dir(spark, "test-corpus")
    for batch in (0, 1, 0):
        collect.append_logs(source(spark, raw_text=f"text {batch}", task_id=None), base, batch)
    assert [r["raw_content"] for r in collect.current_sources(spark, base).collect()] == ["text 1"]
    assert [r["message"] for r in collect.current_chunks(spark, base).collect()] == ["text 1"]


@pytest.mark.parametrize("publish", [False, True])
def test_batches_equal_upserts(spark, publish):
    """Folding all batches on reading gives what upserting one after the other gives."""
    rnd, base = random.Random(5), work_dir(spark, "test-corpus")
    target = work_dir(spark, "test-published") if publish else None
    table = spark.createDataFrame([], LOG_SOURCE)
    for batch in range(3):
        rows = [source(spark, i, raw_text=rnd.choice(["a", "b\nc", ""]), task_id=rnd.choice([None, "", "t"]),
                       pipeline_task_run_id=rnd.choice([None, 0, 1]), dag_id=rnd.choice([None, "d"]))
                for i in range(8)]
        incoming = rows[0]
        for row in rows[1:]:
            incoming = incoming.unionByName(row)
        collect.append_logs(incoming, base, batch)
        table = L.upsert_log_sources(table, L.route_sources(incoming))
        if publish and batch < 2:
            collect.publish_logs(spark, base, target)
    columns = [c for c in LOG_SOURCE.names if c != "collected_at"]
    assert (sorted(map(str, collect.current_sources(spark, base, target).select(*columns).collect()))
            == sorted(map(str, table.select(*columns).collect())))
    assert (sorted(map(str, collect.current_chunks(spark, base, target).collect()))
            == sorted(map(str, collect.current_chunks(spark, base).collect())))


def test_collect_stream(spark):
    path = work_dir(spark, "test-collect")
    columns = [c for c in LOG_SOURCE.names if c not in (
        "id", "content_type", "raw_content", "raw_json", "content_hash", "content_size_bytes",
        "line_count", "collected_at")]
    for number, body in enumerate(['{"content": "one"}', '["two", "ERROR"]']):
        responses = (source(spark).select(*columns, "seq").withColumn("body", F.lit(body))
                     .withColumn("content_type", F.lit("application/json")))
        responses.write.mode("append").json(f"{path}/in")
        stream = spark.readStream.schema(responses.schema).json(f"{path}/in")
        collect.collect_stream(stream, f"{path}/corpus", f"{path}/ck").awaitTermination()
    assert [r["raw_content"] for r in collect.current_sources(spark, f"{path}/corpus").collect()] == ["two\nERROR"]
    assert [r["is_error"] for r in collect.current_chunks(spark, f"{path}/corpus").collect()] == [True]


def test_published_runs_equal_one_fold(spark):
    """Several levels, read as a whole, by key, and after batches that came later."""
    base, target = work_dir(spark, "test-corpus"), work_dir(spark, "test-published")
    written = []
    for batch in range(5):
        incoming = source(spark, raw_text=f"one {batch}", task_id="a")
        if not batch:
            incoming = incoming.unionByName(source(spark, raw_text="other", task_id="b"))
        if batch == 3:
            incoming = source(spark, raw_text="", task_id="b", dag_id=None)
        collect.append_logs(incoming, base, batch)
        written.append(collect.publish_logs(spark, base, target, fanout=2))
    assert [r.level for r in levels.state(spark, target)[1]] == [2, 0]
    # A batch alone, then with those it is merged with.
    assert [w["log_sources"] for w in written] == [2, 1 + 2, 1, 1 + 2 + 2, 1]
    assert collect.publish_logs(spark, base, target) == {"log_sources": 0, "log_chunks": 0}
    assert sorted(r["message"] for r in collect.published(spark, target, "log_chunks").collect()) == ["one 4", "other"]
    sources = collect.published(spark, target, "log_sources").select("id", "task_id", "raw_content", "dag_id", "batch").collect()
    assert sorted((r["task_id"], r["raw_content"], r["batch"]) for r in sources) == [("a", "one 4", 4), ("b", "", 3)]
    one = next(r["id"] for r in sources if r["task_id"] == "b")
    by_key = collect.published(spark, target, "log_chunks", [one])
    assert [r["message"] for r in by_key.collect()] == ["other"]
    assert "In(log_source_id" in plan_text(by_key) or "EqualTo(log_source_id" in plan_text(by_key)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_batch_is_written_again_a_logarithmic_number_of_times():
    runs, written, size = [], 0, {}
    for batch in range(200):
        run = levels.new_run(0, batch, batch)
        runs, size[run.name], written = [*runs, run], 1, written + 1
        while old := levels.due(runs, 8):
            runs, run = levels.merged(runs, old)
            size[run.name] = sum(size[r.name] for r in old)
            written += size[run.name]
        assert [r.first for r in runs] == [0, *[r.upto + 1 for r in runs[:-1]]] and runs[-1].upto == batch
        assert len(runs) <= 7 * 3 + 1
    assert written <= 200 * (1 + 3)


def test_two_writers_publish_both(spark):
    """Each publication has a number of its own, and none is lost."""
    base = work_dir(spark, "test-tables")
    staged = [tables.stage_snapshot(spark.range(i + 1), base, "t") for i in range(8)]
    with ThreadPoolExecutor(8) as pool:
        versions = sorted(pool.map(lambda s: tables.publish_snapshot(spark, s), staged))
    assert versions == list(range(1, 9))
    root = work_dir(spark, "test-parts")
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: parts.publish(spark, root, f"run{i}", [i]), range(8)))
    assert sorted((r["part"], r["run"]) for r in parts.live_parts(spark, root).collect()) == [(i, f"run{i}") for i in range(8)]
    assert sorted(r["version"] for r in parts.manifest(spark, root).collect()) == list(range(1, 9))


def test_a_commit_is_created_once_and_whole(spark):
    folder = work_dir(spark, "test-commits")
    files.make_folder(spark, folder)
    with ThreadPoolExecutor(16) as pool:
        made = list(pool.map(lambda i: commits.create_exclusively(spark, f"{folder}/{commits.name_of(1)}", json.dumps([i] * 1000)), range(16)))
    assert sum(made) == 1
    assert commits.last(spark, folder) == (1, [made.index(True)] * 1000)
    assert files.list_names(spark, folder) == [commits.name_of(1)]


def test_unpublished_batches_are_not_seen(spark):
    """Sources are staged before chunks; until both are there, a reader finds the state of before."""
    base = work_dir(spark, "test-corpus")
    collect.append_logs(source(spark, raw_text="old"), base, 0)
    real, seen = collect.parts.stage, []

    def stage(df, root, table, run):
        n = real(df, root, table, run)
        seen.append(([r["raw_content"] for r in collect.current_sources(spark, base).collect()],
                     [r["message"] for r in collect.current_chunks(spark, base).collect()]))
        return n

    collect.parts.stage = stage
    try:
        collect.append_logs(source(spark, raw_text="new"), base, 1)
    finally:
        collect.parts.stage = real
    assert seen == [(["old"], ["old"])] * 2
    assert [r["message"] for r in collect.current_chunks(spark, base).collect()] == ["new"]


def test_folders_stay_bounded(spark):
    base, target = work_dir(spark, "test-corpus"), work_dir(spark, "test-published")
    for batch in range(14):
        collect.append_logs(source(spark, raw_text=f"text {batch}"), base, batch)
        collect.publish_logs(spark, base, target, fanout=2, keep=3)
        reader = collect.current_chunks(spark, base, target)
        assert [r["message"] for r in reader.collect()] == [f"text {batch}"]
    for root in (base, target):
        for table in ("log_sources", "log_chunks"):
            assert len(tables.list_names(spark, f"{root}/{table}")) <= 8
    assert len([n for n in tables.list_names(spark, f"{base}/manifest") if n.endswith(".json")]) <= 9
    assert len(tables.list_names(spark, f"{target}/runs")) == 3


def test_snapshots_stay_bounded(spark):
    base, df = work_dir(spark, "test-tables"), spark.range(3)
    for _ in range(6):
        tables.write_table(df, base, "t", "parquet", keep=2)
    assert len(tables.list_names(spark, f"{base}/t/snapshots")) == 2
    assert tables.scan_table(spark, base, "t", "parquet").count() == 3
