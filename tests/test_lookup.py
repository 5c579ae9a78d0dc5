"""Lookups that open few row groups."""

import pytest
from pyspark.sql import functions as F

from brontide.operators import project as P
from brontide.session import work_dir
from brontide.sources import tables

N, GROUP = 40_000, 40_000 // 40


@pytest.fixture(scope="module")
def filed(spark):
    """Rows in random order, filed by one key and found by another."""
    base = work_dir(spark, "test-lookup")
    rows = spark.range(N).select((F.col("id") * 7919 % N).alias("k"), F.md5(F.col("id").cast("string")).alias("other"),
                                 F.sha2(F.col("id").cast("string"), 512).alias("body"))
    before = spark.sparkContext._jsc.hadoopConfiguration().get("parquet.block.size.row.count.limit")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.row.count.limit", str(GROUP))
    try:
        tables.write_table(rows.repartition(5), base, "t", "parquet", keys=("k", "other"))
    finally:
        conf.unset("parquet.block.row.count.limit") if before is None else conf.set("parquet.block.row.count.limit", before)
    return tables.scan_table(spark, base, "t", "parquet")


def rows_read(df):
    """Rows that the scan handed on after it skipped row groups."""
    collected = df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []
    text = plan.toString()

    def walk(node):
        if "Scan parquet" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            walk(node.plan())
    walk(plan)
    assert found, text
    return collected, sum(found)


def test_a_key_opens_few_row_groups(filed):
    rows, read = rows_read(P.lookup(filed, k=12_345))
    assert len(rows) == 1 and read <= 2 * GROUP
    # The second key is in no order: the filters leave its row group, and one in a hundred by chance.
    rows, read = rows_read(P.lookup(filed, other=rows[0]["other"]))
    assert len(rows) == 1 and read <= 4 * GROUP
    assert rows_read(P.lookup(filed, other="nowhere"))[1] <= 3 * GROUP


def test_many_keys_open_what_lies_between_them(spark, filed):
    keys = spark.createDataFrame([(k,) for k in range(500, 700)] + [(None,)], "k long")
    rows, read = rows_read(P.lookup_many(filed, keys))
    assert sorted(r["k"] for r in rows) == list(range(500, 700)) and read <= 2 * GROUP
    assert P.lookup_many(filed, keys.limit(0)).count() == 0
    assert P.lookup_many(filed, keys.filter("k is null")).count() == 0
