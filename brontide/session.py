"""Session defaults and the shared work folder."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from brontide.sources.files import delete_path

# Settings the results depend on (time zone) or that large runs rely on (AQE). Memory,
# cores and shuffle partitions belong to the cluster and are left to spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Jobs that are submitted side by side share the executors.
    "spark.scheduler.mode": "FAIR",
    # Streaming state on local disk with uploads of its changes, not in the executors' heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="brontide-")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a machine-local folder: on a cluster the
    executors could not see each other's files there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def small_frame(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A few rows from the driver as a one-partition DataFrame that needs no Python worker."""
    literal = F.lit(json.dumps(rows, default=str, ensure_ascii=False))
    return spark.range(1, numPartitions=1).select(F.inline(F.from_json(literal, T.ArrayType(schema))))


_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing_files(spark: SparkSession):
    """What this thread stores by ``materialize`` within is deleted at the end; for work whose results are stored elsewhere by then."""
    paths: list[str] = []
    token = _PASSING.set(paths)
    try:
        yield
    finally:
        _PASSING.reset(token)
        for path in paths:
            delete_path(spark, path)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# By session: how many pieces of work rely on the setting now, and what it was before the first.
_dropping: dict[str, list] = {}
_lock = Lock()


@contextmanager
def passing_shuffles(spark: SparkSession):
    """The files of each shuffle are deleted when its query ends, not when the driver happens to collect its garbage.

    For work that runs none of its queries twice: what is run again writes its shuffles anew. Threads may overlap.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        state = _dropping.setdefault(session, [0, spark.conf.get(_DROP_SHUFFLES, None)])
        state[0] += 1
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            state[0] -= 1
            if not state[0]:
                del _dropping[session]
                spark.conf.unset(_DROP_SHUFFLES) if state[1] is None else spark.conf.set(_DROP_SHUFFLES, state[1])


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage with files that outlive a lost executor, and keeps an intermediate that
    several later passes need from being computed again.
    """
    path = work_dir(df.sparkSession, label)
    if (passing := _PASSING.get()) is not None:
        passing.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
