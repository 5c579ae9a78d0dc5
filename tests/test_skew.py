"""One source holds nearly all rows, and the other side is too large to be broadcast."""

import pytest
from pyspark.sql import functions as F

from brontide.operators import chunking as C, containers as D, logs as L, project as P
from brontide.plans import collect
from brontide.schemas import LOG_CHUNK
from brontide.session import materialize, work_dir
from brontide.sources import parts

SMALL = {  # so that a few thousand rows count as large and skewed
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(autouse=True)
def small_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run(df) -> tuple[int, str]:
    rows = df.collect()
    return len(rows), df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def skewed(spark, n=60_000):
    """Chunks of which the source ``hot`` has nine in ten."""
    return spark.range(0, n, numPartitions=16).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("log_source_id"),
        F.col("id").alias("chunk_index"), F.sha2(F.col("id").cast("string"), 256).alias("message"))


def test_replace_chunks(spark):
    base = materialize(skewed(spark), "skewed")
    new = spark.range(0, 2000, 10).selectExpr("cast(id as string) as log_source_id", "0L as chunk_index",
                                              "'new' as message")
    n, plan = run(L.replace_chunks(base, new))
    assert n == 60_000 and "skew=true" in plan


def test_lookup_many(spark):
    keys = skewed(spark).select("log_source_id").distinct()
    n, plan = run(P.lookup_many(materialize(skewed(spark), "skewed"), keys))
    assert n == 60_000 and "skew=true" in plan


def test_current_chunks(spark):
    base = work_dir(spark, "test-corpus")
    for batch in (0, 1):
        given = skewed(spark).select(*[
            (F.col(f.name) if f.name in ("log_source_id", "chunk_index", "message")
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in LOG_CHUNK])
        staged = parts.new_run()
        parts.stage(given.withColumn("part", F.lit(batch)), base, "log_chunks", staged)
        parts.publish(spark, base, staged, [batch])
    n, plan = run(collect.current_chunks(spark, base))
    assert n == 60_000 and "skew=true" in plan


def test_long_log_among_short_ones(spark):
    lines = skewed(spark).select(
        F.col("log_source_id").alias("k"), "message",
        F.when(F.col("log_source_id") == "hot", F.col("chunk_index") - F.floor(F.col("chunk_index") / 10))
         .otherwise(1).alias("line_no")).withColumnRenamed("message", "line")
    chunks = C.chunk_lines(materialize(lines, "skewed"), ["k"]).groupBy("k").agg(F.max("line_end").alias("n"))
    found = {r["k"]: r["n"] for r in chunks.collect()}
    assert len(found) == 6001 and found["hot"] == 54_000


def test_daily_sink_splits_a_big_day(spark):
    path = work_dir(spark, "test-daily")
    lines = skewed(spark).select("message", F.when(F.col("log_source_id") == "hot", "2024-01-01")
                                 .otherwise("2024-01-02").cast("timestamp").alias("ts"))
    D.write_daily(lines, path)
    files = [f for f in spark.read.parquet(path).inputFiles() if "2024-01-01" in f]
    assert len(files) > 10 and spark.read.parquet(path).count() == 60_000
