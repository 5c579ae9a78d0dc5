"""Results with tasks that fail after they did their work, and are run again.

In a session of its own, as the number of retries is fixed when a local session starts.
"""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
from pyspark import TaskContext
from pyspark.sql import functions as F
from brontide.operators import chunking as C
from brontide.plans import collect, ingest as I
from brontide.schemas import LOG_SOURCE
from brontide.session import build_session, work_dir
from brontide.sources import tables

spark = build_session("retries", "local[4,4]", **{
    "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.log.level": "OFF"})

def fails_once(batches):
    task = TaskContext.get()
    yield from batches
    if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
        raise RuntimeError("lost")

def flaky(df):
    return df.mapInArrow(fails_once, df.schema)

rows = spark.range(0, 1000, numPartitions=8)
source = flaky(rows.selectExpr("id", "concat('  v', id % 10) as v").unionAll(
    rows.selectExpr("id", "concat('v', id % 10, ' ') as v")))
folders = I.Folders.under(work_dir(spark, "retries"))
assert I.export_table(source, I.TableSpec("t", ("id",)), folders) == 2000
report = I.ingest_table(source, I.TableSpec("t", ("id",)), folders).first()
assert (report["source_rows"], report["cleansed_rows"], report["duplicate_rows_removed"],
        report["target_rows"]) == (2000, 1000, 1000, 1000), report

lines = flaky(rows.selectExpr("'log' as k", "1000 - id as o", "concat('line ', id) as line"))
numbered = C.number_lines(lines, ["k"], ["o"])
assert sorted(r["line_no"] for r in numbered.collect()) == list(range(1, 1001))

kept = {"pipeline_run_id": F.col("id"), "source_type": F.lit("AIRFLOW_LOG"), "seq": F.lit(0),
        "raw_text": F.lit("a\\nb"), "raw_content": F.lit(None).cast("string"),
        "raw_json": F.lit(None).cast("string")}
others = {f.name: F.lit(None).cast(f.dataType) for f in LOG_SOURCE if f.name not in (
    "id", "pipeline_run_id", "source_type", "content_type", "raw_content", "raw_json",
    "content_hash", "content_size_bytes", "line_count", "collected_at")}
logs = flaky(rows.select(*[c.alias(n) for n, c in {**kept, **others}.items()]))
assert collect.append_logs(logs, work_dir(spark, "retries"), 0, max_lines=1) == {
    "log_sources": 1000, "log_chunks": 2000}
print("all counts right")
"""


def test_retried_tasks_change_no_count():
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=Path(__file__).resolve().parents[1],
                          capture_output=True, text=True, timeout=300)
    assert "all counts right" in done.stdout, done.stderr[-3000:]
