"""Registered queries: container log lines."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brontide.catalog.common import Registry, table
from brontide.operators import containers as C
from brontide.session import work_dir
from brontide.sources import tables
from brontide.streaming import containers as S
from brontide.streaming.tail import open_file_system

registry = Registry()

_URL_RULES = [C.RelabelRule("url", ".*(https).*", "service", "tls"),
              C.RelabelRule("url", ".*(/en/).*", "service", "en"),
              C.RelabelRule("url", ".*(page|ref).*", "service", "ref")]


@registry.add("""select page_id, url, case when regexp_full_match(url, '.*(page|ref).*') then 'ref'
    when regexp_full_match(url, '.*(/en/).*') then 'en' when regexp_full_match(url, '.*(https).*') then 'tls' end as service
    from pages""")
def relabel(spark, sf_dir):
    return C.relabel(table(spark, sf_dir, "pages").select("page_id", "url"), _URL_RULES)


# A line per event from one of several containers.
_LINE = {
    "ts": "ts",
    "container_name": """concat('/', case event_type when 'error' then 'airflow-worker' when 'click' then 'spark-master'
        when 'view' then 'airflow-spark-client' when 'signup' then 'minio' else 'redis' end)""",
    "image": "concat('img:', cast(user_id % 5 as varchar(20)))",
    "line": "props",
}
_LINES_SQL = f"select {', '.join(f'{e} as {c}' for c, e in _LINE.items())} from events"
_LABELS_SQL = f"""select ts, container_name as container, image, line,
    case when contains(container_name, 'minio') or contains(container_name, 'mc') then 'minio'
         when contains(container_name, 'spark') then 'spark'
         when contains(container_name, 'airflow') then 'airflow' end as service from ({_LINES_SQL})"""
_ON_TIME = "ts >= (select max(ts) from events) - interval 168 hour"


def _lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} as {c}" for c, e in _LINE.items()])


def _latest(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]


@registry.add(_LABELS_SQL)
def label_containers(spark, sf_dir):
    return C.label_containers(_lines(spark, sf_dir))


@registry.add(f"select event_id, ts, event_type from events where {_ON_TIME}")
def reject_late(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return C.reject_late(events, as_of=_latest(spark, sf_dir))


# Every ninth event has no time.
@registry.add(f"""select count(*) filter (where t is not null and {_ON_TIME}) as kept,
    count(*) filter (where t is not null and not ({_ON_TIME})) as late, count(*) filter (where t is null) as without_time
    from (select ts, case when event_id % 9 > 0 then ts end as t from events)""")
def reject_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 9 > 0, F.col("ts")).alias("ts"))
    return C.reject_counts(events, as_of=_latest(spark, sf_dir))


@registry.add("select cast(ts as date) as day, count(*) as n_rows, cast(sum(user_id) as bigint) as users from events group by 1")
def daily_sink(spark, sf_dir):
    path = work_dir(spark, "daily")
    C.write_daily(table(spark, sf_dir, "events"), path)
    days = spark.read.parquet(path).groupBy("day")
    return days.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("user_id").alias("users"))


class _Growing:
    """The file of one container as it is in a run: longer than before, with an unfinished last line; one is rotated by
    renaming in the second run, one truncated in the third.

    Lines come in the order of their runs and go to the file as they come; of a text, only the last line is held."""

    def __init__(self, root: str, container: str, run: int) -> None:
        self.system, folder = open_file_system(root)
        self.name, self.run = f"{folder}/{container.strip('/')}.log", run
        self.rotated, self.truncated = self.name.endswith("redis.log"), self.name.endswith("minio.log")
        self.first = {(2, True, False): 2, (3, True, False): 2, (3, False, True): 3}.get((run, self.rotated, self.truncated), 1)
        self.old, self.last, self.n, self.later = None, b"", 0, False
        if run == 2 and self.rotated:
            self.system.move(self.name, f"{self.name}.1")
            self.old = self.system.open_output_stream(f"{self.name}.1")
        self.out = self.system.open_output_stream(self.name)

    def add(self, run: int, line: str) -> None:
        if run == 1 and self.old is not None:
            # What was unfinished when the file was renamed is finished first.
            self.old.write(f"{line}\n".encode())
        elif self.first <= run <= self.run:
            self.out.write(self.last)
            self.last = f"{line}\n".encode()
            self.n += 1
        elif run == self.run + 1 and not self.later:
            self.later = True
            # The beginning of the next line, but for files that are truncated then.
            if not (self.run == 2 and self.truncated):
                self.last += line[:9].encode()

    def close(self) -> int:
        if self.run == 1 and self.rotated and not self.later:
            self.last = self.last.decode()[:-5].encode()
        self.out.write(self.last)
        self.out.close()
        if self.old is not None:
            self.old.close()
        return self.n


def _writer(root: str, now: int):
    """Writes rows ``container_name, run, value``, sorted by the first two, as the files of a run; gives the lines of each."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file, counts = None, None, []
        for container, run, line in chain.from_iterable(zip(*[c.to_pylist() for c in batch.columns]) for batch in batches):
            if container != name:
                if file is not None:
                    counts.append(file.close())
                name, file = container, _Growing(root, container, now)
            file.add(run, line)
        if file is not None:
            counts.append(file.close())
        yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], names=["n"])
    return write


@registry.add(f"select *, cast(ts as date) as day from ({_LABELS_SQL}) where {_ON_TIME}")
def stream_tail_logs(spark, sf_dir):
    """Three runs with one checkpoint over files that grow, of which one is rotated and one truncated in between."""
    path, latest = work_dir(spark, "tail"), _latest(spark, sf_dir)
    tables.make_folder(spark, f"{path}/in")
    run = F.expr("case when line < '{\"k\": 4' then 1 when line < '{\"k\": 7' then 2 else 3 end")
    events = table(spark, sf_dir, "events").selectExpr("event_id", *[f"{e} as {c}" for c, e in _LINE.items()])
    json_line = F.to_json(F.struct(F.col("ts").cast("timestamp").alias("ts"), "container_name", "image", "line"),
                          {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    lines = events.select("event_id", "container_name", run.alias("run"), json_line.alias("value"))
    for now in (1, 2, 3):
        dealt = lines.repartition("container_name").sortWithinPartitions("container_name", "run", F.asc_nulls_last("event_id"), "value")
        written = dealt.select("container_name", "run", "value").mapInArrow(_writer(f"{path}/in", now), "n long")
        written.agg(F.sum("n")).collect()
        stream = S.read_growing_logs(spark, f"{path}/in", rangeBytes=1 << 16)
        S.tail_logs(stream, f"{path}/out", f"{path}/checkpoint", as_of=latest, once=True).awaitTermination()
    # The first days are closed, the last ones are not.
    S.compact_days(spark, f"{path}/out", (latest - timedelta(days=3)).date())
    return S.read_daily(spark, f"{path}/out").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
