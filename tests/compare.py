"""Run registered queries next to their SQL on DuckDB."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from brontide.catalog.common import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, Decimal):
        return round(float(v), 9)
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(_value(r[i])).__name__, _value(r[i])) for i in order) for r in rows)


def compare(query, sql: str, spark, con, sf_dir: str) -> str | None:
    """None if both give the same names, types and rows, else what differs."""
    df = query(spark, sf_dir)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    ours, theirs = _rows(df.columns, df.collect()), _rows(names, cursor.fetchall())
    if not theirs:
        return "the SQL has no rows"
    if ours != theirs:
        return (f"{sum(ours.values())} vs {sum(theirs.values())} rows; "
                f"only ours {list((ours - theirs).items())[:2]}; "
                f"only theirs {list((theirs - ours).items())[:2]}")
    return None


if __name__ == "__main__":
    from brontide.session import build_session
    import __spark_entry__ as E

    spark = build_session("compare", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g", "spark.log.level": "ERROR",
        "spark.ui.showConsoleProgress": "false"})
    sf_dir = sys.argv[1]
    con, sql = connect(sf_dir), E.oracle_sql()
    for name, query in E.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = (compare(query, sql[name], spark, con, sf_dir) if name in sql
                       else f"no SQL, {query(spark, sf_dir).count()} rows")
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:24s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
