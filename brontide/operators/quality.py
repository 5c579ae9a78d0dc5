"""Counts, key checks, gates and the data-quality report."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from brontide.errors import DataQualityError
from brontide.operators.project import blank_to_null, column, trim_column_names
from brontide.schemas import DQ_REPORT, TABLE_METADATA
from brontide.session import materialize, small_frame

# Bookkeeping column of a cleansed table: how many source rows collapsed into this one. It lets
# every count of the report come from the written table, so that the source is read only once
# and no count depends on how often a task was run.
COPIES = "_source_copies"
# Bytes from which reading a table again is cheaper than shuffling it.
DIGEST_FROM = 1 << 30
_MOST_BITS = 1 << 27


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- counts -------------------------------------------------------------------------------

def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row ``table, n_rows`` per table."""
    return union_all([row_count(df).select(F.lit(t).alias("table"), "n_rows")
                      for t, df in frames.items()])


def dedup_rows(df: DataFrame, digest_from: int = DIGEST_FROM) -> DataFrame:
    """Distinct rows over all columns; NULLs are equal. For ``digest_from`` see ``dedup_counting``."""
    return dedup_counting(df, digest_from).drop(COPIES)


def dedup_counting(df: DataFrame, digest_from: int = DIGEST_FROM) -> DataFrame:
    """Distinct rows with the number of copies of each in ``COPIES``.

    Where Spark expects ``df`` to have less than ``digest_from`` bytes, or no column of variable width, rows are grouped as they
    are: copies are summed before the shuffle, so a row that makes up a large part of the table reaches the final
    aggregation as one row per map task. Otherwise ``df`` is read again instead, which must give the same rows: a first pass
    groups digests of 64 bits alone, and only rows whose digest may repeat are shuffled and compared as they are.
    """
    each = counted_once(df)
    if not looked_at_twice(df, digest_from):
        return _grouped(df)
    counted = counted_repeats(df)
    return each if counted is None else counted


def counted_once(df: DataFrame) -> DataFrame:
    """Every row as the only one of its kind."""
    if COPIES.lower() in (c.lower() for c in df.columns):
        raise DataQualityError(f"the name {COPIES} is taken by the number of copies")
    return df.select(*[column(c) for c in df.columns], F.lit(1).cast("bigint").alias(COPIES))


def counted_repeats(df: DataFrame) -> DataFrame | None:
    """Distinct rows with the number of copies of each, by digests first, see ``dedup_counting``. None if no digest repeats, as then no
    row does."""
    marked = _marked_repeats(df)
    if marked is None:
        return None
    names = [column(c) for c in df.columns]
    once = marked.filter(~F.col("_repeats")).select(*names, F.lit(1).cast("bigint").alias(COPIES))
    return once.unionByName(_grouped(marked.filter("_repeats").select(*names)))


def looked_at_twice(df: DataFrame, digest_from: int = DIGEST_FROM, n_bytes: int | None = None) -> bool:
    """Whether ``dedup_counting`` reads ``df`` a second time; ``n_bytes`` are its bytes if they are known better than by Spark."""
    fixed = all(isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)) for f in df.schema)
    return not fixed and (expected_bytes(df) if n_bytes is None else n_bytes) >= digest_from


def _grouped(df: DataFrame) -> DataFrame:
    return df.groupBy(*[column(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(COPIES))


def expected_bytes(df: DataFrame) -> int:
    """The optimizer's estimate."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def row_digest(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of all columns, NULLs told apart by their place. Equal rows have equal digests.

    The first does to find rows that may repeat, as rows whose hashes meet by chance are compared as they are."""
    values = [column(c) for c in df.columns]
    return [F.xxhash64(F.lit(seed), *values, *[v.isNull() for v in values]) for seed in (1, 2)]


def _marked_repeats(df: DataFrame) -> DataFrame | None:
    """``df`` with ``_repeats``: whether the digest of a row occurs more than once, or, by chance, shares a bit with one that does.
    None if no digest does.

    The bits, at most ``_MOST_BITS``, are a table of 64-bit words, few enough to be broadcast whatever the size of ``df``; more
    repeated digests than that only mark more rows.
    """
    first = row_digest(df)[0]
    digests = df.select(first.alias("_a")).groupBy("_a").agg((F.count(F.lit(1)) > 1).alias("_again"))
    repeats = materialize(digests.filter("_again").select("_a"), "repeated-digests")
    n_repeats = repeats.count()
    if not n_repeats:
        return None
    n_bits = min(_MOST_BITS, max(1 << 10, 1 << (32 * n_repeats).bit_length()))
    place = F.pmod(F.col("_a"), F.lit(n_bits))
    bit = F.expr(f"shiftleft(1L, cast(pmod(pmod(_a, {n_bits}), 64) as int))")
    words = materialize(repeats.groupBy(F.floor(place / 64).cast("int").alias("_at")).agg(F.bit_or(bit).alias("_bits")), "repeat-bits")
    found = df.withColumn("_a", first).withColumn("_at", F.floor(place / 64).cast("int")).join(F.broadcast(words), "_at", "left")
    return found.withColumn("_repeats", F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))).drop("_a", "_at", "_bits")


def cleanse(df: DataFrame, digest_from: int = DIGEST_FROM) -> DataFrame:
    """Trimmed names, trimmed strings with blanks as NULL, distinct rows with copy counts."""
    return dedup_counting(trimmed(df), digest_from)


def trimmed(df: DataFrame) -> DataFrame:
    """Trimmed names, trimmed strings with blanks as NULL."""
    return blank_to_null(trim_column_names(df))


def duplicates_removed(df: DataFrame, digest_from: int = DIGEST_FROM) -> DataFrame:
    """Rows before, after and removed by cleansing."""
    return cleanse(df, digest_from).agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("source_rows"),
        F.count(F.lit(1)).alias("cleansed_rows"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("duplicate_rows_removed"))


# --- keys ---------------------------------------------------------------------------------

def require_keys_present(df: DataFrame, keys: list[str]) -> None:
    """Fail before any job runs when a declared key column is missing."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise DataQualityError(f"key columns missing: {missing}")


def pk_null_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row ``pk, nulls`` per key column, from one pass over the key columns."""
    counts = df.agg(*[F.count_if(column(k).isNull()).alias(f"n{i}") for i, k in enumerate(keys)])
    pairs = F.array(*[F.struct(F.lit(k).alias("pk"), F.col(f"n{i}").alias("nulls"))
                      for i, k in enumerate(keys)])
    return counts.select(F.inline(pairs))


def pk_duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of key tuples that occur more than once."""
    per_key = df.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.filter(F.col("_n") > 1).agg(F.count(F.lit(1)).alias("duplicate_keys"))


def quality_metrics(cleansed: DataFrame, keys: list[str]) -> DataFrame:
    """All counts of the report as one row, from one pass over keys and ``COPIES``.

    Rows are first grouped by key, which serves the duplicate check; the other counts are sums
    over the groups. Columns ``nulls_0, nulls_1, ...`` follow the order of ``keys``.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    slim = cleansed.select(*[column(k).alias(n) for k, n in zip(keys, names)], COPIES)
    per_key = (slim.groupBy(*names) if keys else slim.groupBy(F.lit(0).alias("_all"))).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(COPIES).alias("_copies"))

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0))

    return per_key.agg(
        total("_copies").alias("source_rows"),
        total("_rows").alias("cleansed_rows"),
        total(F.col("_copies") - F.col("_rows")).alias("duplicate_rows_removed"),
        *[total(F.when(F.col(n).isNull(), F.col("_rows"))).alias(f"nulls_{i}")
          for i, n in enumerate(names)],
        (F.count_if(F.col("_rows") > 1) if keys else F.lit(0).cast("bigint")).alias("duplicate_keys"))


# --- report and gates ---------------------------------------------------------------------

def quality_report(table: str, metrics: DataFrame, keys: list[str],
                   source_path: str, target_path: str) -> DataFrame:
    """The report row of a table from its metrics row."""
    return metrics.select(
        F.lit(table).alias("table"), "source_rows", "cleansed_rows", "duplicate_rows_removed",
        F.array(*[F.lit(k) for k in keys]).cast("array<string>").alias("primary_keys"),
        F.lit(source_path).alias("source_path"), F.lit(target_path).alias("target_path"),
    ).to(DQ_REPORT)


def quality_checks(table: str, cleansed: DataFrame, keys: list[str]) -> DataFrame:
    """One row ``table, check, value, passed`` per check of a cleansed table.

    With a key column missing there is no key to check, only that row and the counts.
    """
    missing = [k for k in keys if k not in cleansed.columns]
    found = [] if missing else keys

    def check(name, value, passed):
        return F.struct(F.lit(name).alias("check"), value.cast("bigint").alias("value"),
                        passed.alias("passed"))

    def zero(name, value):
        return check(name, value, value == 0)

    checks = [zero("pk_columns_missing", F.lit(len(missing)))]
    checks += [zero(f"pk_nulls:{k}", F.col(f"nulls_{i}")) for i, k in enumerate(found)]
    if found:
        checks.append(zero("pk_duplicate_keys", F.col("duplicate_keys")))
    increase = F.greatest(F.col("cleansed_rows") - F.col("source_rows"), F.lit(0))
    checks.append(zero("rows_not_increased", increase))
    return quality_metrics(cleansed, found).select(F.lit(table).alias("table"),
                                                   F.inline(F.array(*checks)))


def require_quality(table: str, metrics: dict, keys: list[str]) -> None:
    """Gate on a metrics row that is already on the driver."""
    for i, key in enumerate(keys):
        if metrics[f"nulls_{i}"]:
            raise DataQualityError(f"{table}: {metrics[f'nulls_{i}']} NULLs in key column {key}")
    if metrics["duplicate_keys"]:
        raise DataQualityError(f"{table}: {metrics['duplicate_keys']} duplicate keys")
    require_not_increased(table, metrics["source_rows"], metrics["cleansed_rows"])


def require_not_increased(table: str, source_rows: int, cleansed_rows: int) -> None:
    if cleansed_rows > source_rows:
        raise DataQualityError(f"{table}: cleansing grew {source_rows} rows to {cleansed_rows}")


def reconcile_counts(table: str, source: DataFrame, target: DataFrame) -> DataFrame:
    """One row ``table, source_rows, target_rows, ok``.

    Both sides are tagged and counted in one aggregation, so neither a join nor a collect of
    more than one row is needed.
    """
    tagged = (source.select(F.lit(1).alias("s"), F.lit(0).alias("t"))
                    .unionAll(target.select(F.lit(0).alias("s"), F.lit(1).alias("t"))))
    counts = tagged.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
                        F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows"))
    return counts.select(F.lit(table).alias("table"), "source_rows", "target_rows",
                         (F.col("source_rows") == F.col("target_rows")).alias("ok"))


def require_equal_counts(table: str, source_rows: int, target_rows: int) -> None:
    if source_rows != target_rows:
        raise DataQualityError(f"{table}: source has {source_rows} rows, target {target_rows}")


def min_rows(df: DataFrame, table: str, thresholds: list[int]) -> DataFrame:
    """One row ``table, min_rows, n_rows, passed`` per threshold."""
    limits = F.explode(F.array(*[F.lit(n).cast("bigint") for n in thresholds])).alias("min_rows")
    return (row_count(df).select(F.lit(table).alias("table"), limits, "n_rows")
                         .withColumn("passed", F.col("n_rows") >= F.col("min_rows")))


def require_min_rows(df: DataFrame, table: str, n: int = 0) -> int:
    found = row_count(df).first()["n_rows"]
    if found < n:
        raise DataQualityError(f"{table}: {found} rows, at least {n} wanted")
    return found


def preview(df: DataFrame, order_by: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in a fixed order."""
    return df.orderBy(*[column(c) for c in order_by]).limit(n)


# --- catalog ------------------------------------------------------------------------------

@dataclass(frozen=True)
class ForeignKey:
    column: str
    ref_table: str
    ref_column: str


def table_metadata(spark: SparkSession, table: str, schema, primary_keys=(), foreign_keys=(),
                   row_count: int = 0, csv_path: str = "") -> DataFrame:
    """The one-row metadata document of a table.

    ``primary_keys`` is in key order, which need not be the column order.
    """
    if not schema.fields:
        raise ValueError(f"table has no columns: {table}")
    position = {k: i for i, k in enumerate(primary_keys, start=1)}
    columns = [{"cid": i, "name": f.name, "type": f.dataType.simpleString(),
                "notnull": int(not f.nullable), "pk": position.get(f.name, 0)}
               for i, f in enumerate(schema.fields)]
    references = [{"id": i, "seq": 0, "table": fk.ref_table, "from": fk.column, "to": fk.ref_column}
                  for i, fk in enumerate(foreign_keys)]
    row = {"table": table, "columns": columns, "primary_keys": list(primary_keys),
           "foreign_keys": references, "row_count": row_count, "csv_path": csv_path}
    return small_frame(spark, [row], TABLE_METADATA)


def table_catalog(metadata: DataFrame) -> DataFrame:
    """One row per column of each metadata document."""
    return metadata.select("table", "row_count", F.inline("columns"))


def foreign_key_catalog(metadata: DataFrame) -> DataFrame:
    """One row per declared foreign key of each metadata document."""
    fks = metadata.select("table", "row_count", F.explode("foreign_keys").alias("fk"))
    return fks.select("table", F.col("fk.id").alias("id"), F.col("fk.`from`").alias("from_column"),
                      F.col("fk.`table`").alias("ref_table"), F.col("fk.`to`").alias("to_column"),
                      "row_count")
