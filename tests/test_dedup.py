"""Deduplication by digests first."""

import pytest
from pyspark.sql import functions as F

from brontide.operators import quality as Q

nan = float("nan")
ROWS = [("a", 1, 0.0, None), ("a", 1, -0.0, None), ("a", 1, nan, None), ("a", 1, nan, None), (None, 1, 0.5, "a"), ("a", 1, 0.5, None), (None, 1, 0.5, "a"),
        ("", None, None, ""), ("", None, None, ""), (None, None, None, None), (None, None, None, None), ("b" * 1000, 2, 1.0, "c"), ("b", 3, 1.0, "c")]
SCHEMA = "`a.b` string, n int, d double, t string"


def counted(df, **options):
    return sorted((str(tuple(r)) for r in Q.dedup_counting(df, **options).collect()))


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS * 3 + [(str(i), i, float(i), "x") for i in range(500)], SCHEMA)


def test_same_rows_as_grouping(df):
    assert counted(df, digest_from=0) == counted(df)
    assert Q.dedup_rows(df, 0).count() == Q.dedup_rows(df).count() == 9 + 500 - 1
    assert counted(df.limit(0), digest_from=0) == []


def test_colliding_digests_are_kept_apart(df, monkeypatch):
    expected = counted(df)
    monkeypatch.setattr(Q, "row_digest", lambda df: [F.lit(5).cast("bigint"), F.col("n").cast("bigint") % 3])
    assert counted(df, digest_from=0) == expected
    monkeypatch.setattr(Q, "_MOST_BITS", 1 << 10)
    monkeypatch.setattr(Q, "row_digest", lambda df: [F.coalesce(F.col("n"), F.lit(0)).cast("bigint"), F.lit(0).cast("bigint")])
    assert counted(df, digest_from=0) == expected


def test_rows_that_occur_once_are_not_shuffled(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id"), F.repeat(F.lit("long text "), 20).alias("text"))
    rows.unionByName(rows.filter("id % 1000 = 0")).write.parquet(str(tmp_path / "t"))
    found = Q.dedup_counting(spark.read.parquet(str(tmp_path / "t")), digest_from=0)
    found.write.format("noop").mode("overwrite").save()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("Union") == 1
    marked = Q._marked_repeats(spark.read.parquet(str(tmp_path / "t")))
    # The repeated rows, and few others by chance; the join moves no row.
    assert 40 <= marked.filter("_repeats").count() < 1500
    text = marked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_narrow_tables_are_grouped(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("b"))
    text = Q.dedup_counting(df, digest_from=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in text


def test_without_repeats_rows_are_taken_as_they_are(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, None)], "`a.b` int, v string")
    assert Q.counted_repeats(df) is None
    assert counted(df, digest_from=0) == counted(df)
    assert Q.dedup_counting(df, 0).schema.simpleString() == Q.dedup_counting(df).schema.simpleString()
