"""Projections, lookups and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from brontide.session import materialize


def column(name: str) -> Column:
    """Column by its exact name, also when the name holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def trim_column_names(df: DataFrame) -> DataFrame:
    """Strip all whitespace around column names; names must stay distinct."""
    names = [c.strip() for c in df.columns]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"column names collide after trimming: {names}")
    return df if names == df.columns else df.toDF(*names)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Trim spaces in every string column and turn empty strings into NULL."""
    return df.select(*[
        F.nullif(F.trim(column(f.name)), F.lit("")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else column(f.name)
        for f in df.schema.fields
    ])


def null_key_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in which any key column is NULL."""
    condition = F.lit(False)
    for key in keys:
        condition = condition | column(key).isNull()
    return df.filter(condition)


def lookup(df: DataFrame, **key) -> DataFrame:
    """Rows whose columns equal the given values, for one id or one composite key."""
    for name, value in key.items():
        df = df.filter(column(name) == F.lit(value))
    return df


def lookup_many(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``; the key is all columns of ``keys``.

    The keys are stored first: Spark broadcasts them if their real size allows, and else can
    split a key that holds much of ``df`` between tasks, which it does only for joins whose sides
    come straight from a shuffle. Their bounds reach the scan, so that files and row groups beyond
    them are skipped where ``df`` is filed by its key.
    """
    stored = materialize(keys, "lookup-keys")
    atomic = [f.name for f in keys.schema if isinstance(f.dataType, T.AtomicType)]
    if atomic:
        bounds = stored.agg(*[f(column(c)) for c in atomic for f in (F.min, F.max)]).first()
        for i, name in enumerate(atomic):
            if bounds[2 * i] is not None:
                df = df.filter(column(name).between(F.lit(bounds[2 * i]), F.lit(bounds[2 * i + 1])))
    return df.join(stored, keys.columns, "left_semi")


def latest_n(df: DataFrame, columns: list[str], by: str = "id", n: int = 20) -> DataFrame:
    """The ``n`` rows with the highest ``by``, as a top-n report; of equal ones at its end any."""
    return df.select(*columns).orderBy(F.desc(by)).limit(n)
