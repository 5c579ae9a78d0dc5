"""Container log lines."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from brontide.operators.project import column


@dataclass(frozen=True)
class RelabelRule:
    """Set ``target`` to ``replacement`` where ``source`` matches ``regex`` as a whole."""

    source: str
    regex: str
    target: str
    replacement: str


# Fixed values ------------------------------------------------------------------------------
SERVICE_RULES = (
    RelabelRule("container_name", ".*(airflow).*", "service", "airflow"),
    RelabelRule("container_name", ".*(spark).*", "service", "spark"),
    RelabelRule("container_name", ".*(minio|mc).*", "service", "minio"),
)
MAX_AGE = timedelta(hours=168)
# -------------------------------------------------------------------------------------------


def relabel(df: DataFrame, rules=SERVICE_RULES) -> DataFrame:
    """Add the target columns of ``rules``; of several rules that match the last one decides."""
    targets: dict[str, Column] = {}
    for rule in reversed(rules):
        matches = column(rule.source).rlike(f"(?s)^(?:{rule.regex})$")
        value = F.when(matches, F.lit(rule.replacement))
        earlier = targets.get(rule.target)
        targets[rule.target] = value if earlier is None else F.coalesce(earlier, value)
    return df.withColumns(targets)


def label_containers(df: DataFrame) -> DataFrame:
    """Container lines with the labels ``container``, ``image`` and ``service``."""
    return relabel(df).withColumnRenamed("container_name", "container")


def _oldest(df: DataFrame, ts: str, as_of: datetime | Column | None, max_age: timedelta) -> Column:
    if isinstance(as_of, datetime):
        # By way of text, so that the session's time zone applies and not the driver's.
        return F.lit((as_of - max_age).isoformat(" ")).cast(df.schema[ts].dataType)
    return (F.current_timestamp() if as_of is None else as_of) - F.lit(max_age)


def reject_late(df: DataFrame, ts: str = "ts", as_of: datetime | Column | None = None,
                max_age: timedelta = MAX_AGE) -> DataFrame:
    """Rows at most ``max_age`` older than ``as_of``, by default the current time.

    Given a ``datetime`` the limit is a literal, which reaches the scan as a pushed filter. Rows without
    a time are rejected too; ``reject_counts`` tells how many of which kind.
    """
    return df.filter(column(ts) >= _oldest(df, ts, as_of, max_age))


def reject_counts(df: DataFrame, ts: str = "ts", as_of: datetime | Column | None = None,
                  max_age: timedelta = MAX_AGE) -> DataFrame:
    """One row ``kept, late, without_time`` of what ``reject_late`` does with ``df``, from its times alone."""
    late = column(ts) < _oldest(df, ts, as_of, max_age)
    return df.agg(F.count_if(F.coalesce(~late, F.lit(False))).alias("kept"),
                  F.count_if(F.coalesce(late, F.lit(False))).alias("late"),
                  F.count_if(column(ts).isNull()).alias("without_time"))


def write_daily(df: DataFrame, path: str, ts: str = "ts", mode: str = "append") -> None:
    """Write into one folder per day.

    The rebalance keeps a day's rows together so that files are few and large, and lets Spark
    split a day that outgrows a task.
    """
    (df.withColumn("day", F.to_date(column(ts))).hint("rebalance", "day")
       .write.mode(mode).partitionBy("day").parquet(path))
