import datetime as dt

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brontide.catalog import containers as catalog
from brontide.operators import containers as C
from brontide.sources import tables
from brontide.session import work_dir
from brontide.streaming import containers as S


@pytest.mark.parametrize("name, service", [
    ("/airflow-worker", "airflow"), ("airflow-spark", "spark"), ("spark-minio", "minio"),
    ("mc", "minio"), ("redis", None), ("a\nspark\n", "spark"), ("", None)])
def test_last_matching_rule_wins(spark, name, service):
    df = spark.createDataFrame([(name, "i")], "container_name string, image string")
    row = C.label_containers(df).first()
    assert (row["container"], row["image"], row["service"]) == (name, "i", service)


def test_rules_match_the_whole_value(spark):
    df = spark.createDataFrame([("ab",), ("b",)], "s string")
    rules = [C.RelabelRule("s", "a|b", "t", "x")]
    assert [r["t"] for r in C.relabel(df, rules).collect()] == [None, "x"]


def test_late_rows(spark):
    now = dt.datetime(2024, 1, 10)
    limit = now - dt.timedelta(hours=168)
    df = spark.createDataFrame([(limit - dt.timedelta(microseconds=1),), (limit,), (now,)], "ts timestamp_ntz")
    assert C.reject_late(df, as_of=now).count() == 2
    zoned = df.withColumn("ts", F.col("ts").cast("timestamp"))
    assert C.reject_late(zoned, as_of=now).count() == 2
    assert C.reject_late(zoned, as_of=F.lit("2024-01-10").cast("timestamp")).count() == 2
    assert C.reject_late(zoned).count() == 0


def test_limit_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("ts")
    late = C.reject_late(events, as_of=dt.datetime(2024, 1, 20))
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan


def test_daily_folders_are_pruned(spark):
    path = work_dir(spark, "test-daily")
    C.write_daily(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), path)
    day = spark.read.parquet(path).filter("day = date '2024-01-05'")
    assert "PartitionFilters: [isnotnull(day" in day._jdf.queryExecution().executedPlan().toString()
    assert 0 < day.count() < 1000


def test_tail_picks_up_each_line_once(spark):
    path, now = work_dir(spark, "test-tail"), dt.datetime(2024, 1, 10)
    counts = []
    for hours in ([0, 1, 200], [2], []):
        rows = [(now - dt.timedelta(hours=h), "spark", "i", str(h)) for h in hours]
        if rows:
            (spark.createDataFrame(rows, "ts timestamp_ntz, container_name string, image string, line string")
                  .withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1)
                  .write.mode("append").json(f"{path}/in"))
        lines = S.read_container_lines(spark, f"{path}/in")
        S.tail_logs(lines, f"{path}/out", f"{path}/ck", as_of=now, once=True).awaitTermination()
        counts.append(S.read_daily(spark, f"{path}/out").count())
    assert counts == [2, 3, 3]


def test_many_triggers_and_compactions(spark):
    """Days stay whole through compactions, late lines for a closed day included, and files stay few."""
    path, now = work_dir(spark, "test-tail"), dt.datetime(2024, 1, 10)
    for i in range(12):
        rows = [(now - dt.timedelta(days=i % 4), "spark", "i", str(i)), (now, "minio", "i", f"now {i}")]
        (spark.createDataFrame(rows, "ts timestamp_ntz, container_name string, image string, line string")
              .withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").json(f"{path}/in"))
        S.tail_logs(S.read_container_lines(spark, f"{path}/in"), f"{path}/out", f"{path}/ck", as_of=now, once=True).awaitTermination()
        if i % 3 == 2:
            S.compact_days(spark, f"{path}/out", dt.date(2024, 1, 10), keep=1)
        found = sorted(r["line"] for r in S.read_daily(spark, f"{path}/out").collect())
        assert found == sorted([str(k) for k in range(i + 1)] + [f"now {k}" for k in range(i + 1)])
    assert S.compact_days(spark, f"{path}/out", dt.date(2024, 1, 10), keep=1) == 0
    assert S.compact_days(spark, f"{path}/out", dt.date(2024, 1, 11), keep=1) > 0
    S.compact_days(spark, f"{path}/out", dt.date(2024, 1, 11), keep=1)
    assert tables.list_names(spark, f"{path}/out/open") == []
    assert S.read_daily(spark, f"{path}/out").count() == 24 and len(tables.list_names(spark, f"{path}/out/closed")) <= 5


def test_growing_files_are_written_as_lines_come(tmp_path):
    """Of a container, however long its log, a task holds one batch; runs add to what was there."""
    name, sizes = tmp_path / "redis.log", []

    def rows(run):
        for i in range(20):
            lines = [f"{{line {i} {j}}}" for j in range(5000)]
            yield pa.RecordBatch.from_pydict({"container_name": ["/redis"] * 5000, "run": [1 if i < 10 else 2] * 5000, "value": lines})
            sizes.append(name.stat().st_size)

    text = ["".join(f"{{line {i} {j}}}\n" for i in part for j in range(5000)) for part in (range(10), range(10, 20))]
    out, = catalog._writer(str(tmp_path), 1)(rows(1))
    assert out.column("n").to_pylist() == [50_000] and sizes[5] > 0
    assert name.read_text() == text[0] + "{line 10 "
    out, = catalog._writer(str(tmp_path), 2)(rows(2))
    assert out.column("n").to_pylist() == [50_000]
    assert (name.read_text(), (tmp_path / "redis.log.1").read_text()) == (text[1], text[0])
