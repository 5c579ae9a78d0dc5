"""Container log lines as a stream."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from brontide.operators.containers import MAX_AGE, label_containers, reject_late, write_daily
from brontide.schemas import CONTAINER_LINE, TAILED
from brontide.session import materialize
from brontide.sources import parts, tables
from brontide.streaming.tail import read_growing_lines

REFRESH = "5 seconds"


def read_container_lines(spark: SparkSession, path: str, fmt: str = "json", **options) -> DataFrame:
    """Lines of files that are complete when they appear; each file is read once."""
    return spark.readStream.schema(CONTAINER_LINE).format(fmt).options(**options).load(path)


def read_growing_logs(spark: SparkSession, path: str, **options) -> DataFrame:
    """Lines, as JSON, of files that grow, by byte position; see ``streaming/tail.py``. A line that is no JSON has no time."""
    lines = read_growing_lines(spark, path, **options)
    return lines.select(F.from_json("line", CONTAINER_LINE).alias("_line")).select("_line.*")


def tail_logs(lines: DataFrame, path: str, checkpoint: str, *, as_of: datetime | None = None,
              max_age: timedelta = MAX_AGE, once: bool = False) -> StreamingQuery:
    """Label new lines, reject late ones and file the rest by batch and day.

    The checkpoint holds the positions, so every line is picked up once over all runs; a batch that is run
    again overwrites its folder. A day of a batch is one file, or several if it is large. Looks for new
    input every few seconds, or with ``once`` takes what is there and ends. To be read by ``read_daily``.
    """
    kept = reject_late(label_containers(lines), as_of=as_of, max_age=max_age)

    def add(batch: DataFrame, batch_id: int) -> None:
        write_daily(batch, f"{path}/open/batch={batch_id}", mode="overwrite")

    trigger = {"availableNow": True} if once else {"processingTime": REFRESH}
    return kept.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _day_number(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("bigint")


def _open_lines(spark: SparkSession, path: str, rows: dict[int, int]) -> DataFrame | None:
    """Lines that no closed day holds; ``rows`` are the last batches of the closed days."""
    if not any("batch=" in name for name in tables.list_names(spark, f"{path}/open")):
        return None
    schema = f"{TAILED.toDDL()}, batch BIGINT, day DATE"
    lines = spark.read.schema(schema).parquet(f"{path}/open").withColumn("part", _day_number(F.col("day")))
    held = F.lit(False)
    if rows:
        last = F.element_at(F.create_map(*[F.lit(x) for pair in rows.items() for x in pair]), F.col("part"))
        held = F.coalesce(F.col("batch") <= last, F.lit(False))
    return lines.filter(~held)


def _closed(spark: SparkSession, path: str) -> dict[int, int]:
    return {r["part"]: r["upto"] for r in parts.live_parts(spark, path).collect()}


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """All lines filed under ``path`` with their ``day``."""
    closed, columns = _closed(spark, path), [*TAILED.names, "day"]
    day = F.to_date(F.col("part").cast("string"), "yyyyMMdd")
    done = parts.scan(spark, path, "closed", TAILED).withColumn("day", day).select(*columns)
    rest = _open_lines(spark, path, closed)
    return done if rest is None else done.unionByName(rest.select(*columns))


def compact_days(spark: SparkSession, path: str, before: date, keep: int = 3) -> int:
    """File every day before ``before`` as a few large files; returns the lines written.

    Only days with lines since their last compaction are written. Readers see a day as it was or as it is
    now. Files go when neither the present state nor the last ``keep`` compactions need them.
    """
    closed = _closed(spark, path)
    rest = _open_lines(spark, path, closed)
    # Batches whose days were all closed by then are not needed by readers of that state.
    for name in tables.list_names(spark, f"{path}/open"):
        days = [n for n in tables.list_names(spark, f"{path}/open/{name}") if n.startswith("day=")]
        numbers = [int(d.removeprefix("day=").replace("-", "")) for d in days]
        if name.startswith("batch=") and all(closed.get(n, -1) >= int(name.removeprefix("batch=")) for n in numbers):
            tables.delete_path(spark, f"{path}/open/{name}")
    found = None if rest is None else materialize(rest.filter(F.col("day") < F.lit(before)), "closing")
    summary = [] if found is None else found.groupBy("part").agg(F.max("batch").alias("upto")).collect()
    if not summary:
        return 0
    days, upto = [r["part"] for r in summary], max(r["upto"] for r in summary)
    old = parts.scan(spark, path, "closed", TAILED).filter(F.col("part").isin(days))
    lines = old.unionByName(found.select(*TAILED.names, "part")).hint("rebalance", "part")
    run = parts.new_run()
    written = parts.stage(lines, path, "closed", run)
    parts.publish(spark, path, run, days, upto)
    parts.prune(spark, path, ["closed"], keep)
    return written
