"""Shapes of physical plans that large inputs depend on."""

import pytest
import __spark_entry__ as entry_points
from brontide.operators import upsert as upsert_module, chunking as C, logs as L, project as P, quality as Q
from brontide.session import small_frame

SF_DIR = "/root/testdata/sf0.001"
# Queries that run no job before they return.
LAZY = ["trim_column_names", "blank_to_null", "null_key_rows", "lookup_by_id", "lookup_by_pair",
        "latest_n", "row_count", "dedup_rows", "duplicates_removed", "pk_null_counts",
        "pk_duplicate_keys", "dq_checks", "min_rows", "preview", "pick_content",
        "fingerprint_text", "normalize_json_source", "route_sources", "extract_log_text",
        "explode_task_instances", "split_lines", "chunk_text", "annotate_chunks",
        "upsert_log_sources", "upsert_resources", "replace_chunks", "affected_rows",
        "normalize_events", "dedup_events", "run_state", "select_followups", "relabel"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.mark.parametrize("name", LAZY)
def test_no_product_of_tables(spark, name):
    text = plan(entry_points.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["chunk_text", "split_lines", "fingerprint_text", "annotate_chunks",
                                  "relabel", "normalize_events"])
def test_row_wise_operators_neither_shuffle_nor_leave_the_jvm(spark, name):
    text = plan(entry_points.queries()[name](spark, SF_DIR))
    assert "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize("name", ["route_sources", "normalize_json_source", "explode_task_instances", "external_log_url"])
def test_only_what_the_jvm_refuses_goes_to_python(spark, name):
    text = plan(entry_points.queries()[name](spark, SF_DIR))
    assert "Exchange" not in text and text.count("ArrowEvalPython") == 1
    below = text.split("ArrowEvalPython")[1]
    assert "CASE WHEN" in below and "parseJson" in below
    # Parsed once, for both readers.
    assert name == "external_log_url" or text.count("parseJson") == 1


def test_text_is_split_and_folded_once(spark):
    text = plan(C.chunk_text(table(spark, "documents").select("doc_id", "text")))
    assert text.count("aggregate(") == 1
    assert text.count("split(text") == 2  # at the pattern or at the line feed


def test_deduplication_aggregates_before_the_shuffle(spark):
    text = plan(Q.cleanse(table(spark, "customer")))
    before, after = text.split("Exchange hashpartitioning")
    assert "functions=[count(1)]" in before and "partial_count(1)" in after


def test_events_aggregate_before_the_shuffle(spark):
    events = entry_points.queries()["dedup_events"](spark, SF_DIR)
    assert "partial_min_by" in plan(events).split("Exchange")[1]


def test_metrics_read_keys_only(spark, tmp_path):
    Q.cleanse(table(spark, "customer")).write.parquet(str(tmp_path / "c"))
    text = plan(Q.quality_metrics(spark.read.parquet(str(tmp_path / "c")), ["c_custkey"]))
    assert f"ReadSchema: struct<c_custkey:bigint,{Q.COPIES}:bigint>" in text


def test_lookup_reaches_the_scan(spark):
    text = plan(P.lookup(table(spark, "orders"), o_orderkey=7))
    assert "EqualTo(o_orderkey,7)" in text


def test_small_batch_does_not_shuffle_the_table(spark, tmp_path):
    """Neither rows nor keys of the table move, and nothing is sorted."""
    rule = L.UpsertRule(key={"doc_id": None}, keep=("doc_id",), fill=("lang",), overwrite=("text",), seq="doc_id")
    base = table(spark, "documents").select("doc_id", "lang", "text")
    batch = small_frame(spark, [{"doc_id": 1, "text": "new"}], base.schema)
    batch.write.parquet(str(tmp_path / "b"))
    jobs = []
    real = upsert_module.materialize

    def watched(df, label):
        jobs.append(plan(df))
        return real(df, label)

    upsert_module.materialize = watched
    try:
        merged = L.upsert(base, spark.read.parquet(str(tmp_path / "b")), rule)
    finally:
        upsert_module.materialize = real
    text = plan(merged)
    assert "Exchange" not in text.replace("BroadcastExchange", "") and "Sort" not in text
    # The steps before: the batch stored, its outcome, the fold and the keys found in the table.
    assert len(jobs) == 4
    stored, outcome, folded, matched = jobs
    assert "Exchange" not in stored and "text" not in outcome
    for step in (folded, matched):
        assert "Exchange" not in step.replace("BroadcastExchange", "") and "Sort" not in step
    assert merged.count() == base.count()


def test_irregular_payloads_alone_go_to_python(spark):
    df = spark.createDataFrame([("plain",)], "payload string")
    text = plan(L.extract_log_text(df))
    assert "CASE WHEN isnull(_flat" in text.split("ArrowEvalPython")[1].split("\n")[0]


def test_run_state_keeps_only_ordered_maxima(spark):
    events = entry_points.queries()["run_state"](spark, SF_DIR)
    text = plan(events)
    assert text.count("Exchange hashpartitioning") == 1 and "partial_max" in text
