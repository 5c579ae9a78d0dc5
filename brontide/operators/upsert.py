"""Keyed upserts of a batch into a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from brontide.operators.project import column
from brontide.session import materialize


@dataclass(frozen=True)
class UpsertRule:
    """What an upsert does with each column.

    ``key`` maps the name of each key column to the value that stands for NULL in comparisons,
    or None where a key is never NULL. On a match, ``keep`` columns stay as they are in the
    table, ``fill`` columns take the new value unless it is NULL, and ``overwrite`` columns take
    the new value also when it is NULL. Rows of one batch are applied in the order of ``seq``.
    """

    key: dict[str, object]
    keep: tuple[str, ...]
    fill: tuple[str, ...]
    overwrite: tuple[str, ...]
    seq: str = "seq"

    @property
    def columns(self) -> list[str]:
        return [*self.keep, *self.fill, *self.overwrite]

    def key_struct(self) -> Column:
        return F.struct(*[
            (column(c) if default is None else F.coalesce(column(c), F.lit(default))).alias(c)
            for c, default in self.key.items()])


def _keyed(rows: DataFrame, rule: UpsertRule) -> DataFrame:
    """The columns of the rule with the key; a NULL in the order fails, as it would decide nothing."""
    kind = rows.schema[rule.seq].dataType
    seq = F.coalesce(column(rule.seq), F.raise_error(F.lit(f"NULL in {rule.seq}")).cast(kind))
    return rows.select(*[column(c) for c in rule.columns], seq.alias("_seq"), rule.key_struct().alias("_key"))


def _outcome(keyed: DataFrame, rule: UpsertRule, order: Column) -> DataFrame:
    """Per key all but the overwritten columns, and the place of the row that has these. What may be wide
    is not touched, so that only keys and short values are aggregated and shuffled."""
    return keyed.groupBy("_key").agg(
        F.min_by(F.struct(*[column(c) for c in rule.keep]), order).alias("_keep"), F.max(order).alias("_last"),
        *[F.max_by(column(c), F.when(column(c).isNotNull(), order)).alias(c) for c in rule.fill])


def _with_last(rows: DataFrame, outcome: DataFrame, rule: UpsertRule, on: Column) -> DataFrame:
    last = rows.select(*[column(c).alias(f"_new_{c}") for c in rule.overwrite], F.col("_key").alias("_own"), "_seq",
                       *(["_row"] if "_row" in rows.columns else []))
    return last.join(outcome, on).select("_key", "_keep.*", *rule.fill, *[F.col(f"_new_{c}").alias(c) for c in rule.overwrite])


def fold_batch(incoming: DataFrame, rule: UpsertRule) -> DataFrame:
    """One row per key with the effect of all its rows in the batch, ties of the order in any way.

    The batch is stored once. What each key ends as is aggregated over its narrow columns, before the
    shuffle, so a key with very many rows is one row per map task there. The few rows whose wide
    columns remain are looked up afterwards; where the outcome is small the others do not move.
    """
    stored = materialize(_keyed(incoming, rule).withColumn("_row", F.monotonically_increasing_id()), "batch")
    outcome = materialize(_outcome(stored, rule, F.struct("_seq", "_row")), "batch-outcome")
    return _with_last(stored, outcome, rule, F.col("_row") == F.col("_last._row"))


def fold_rows(rows: DataFrame, rule: UpsertRule) -> DataFrame:
    """The same for stored rows of which no two have both the key and the place in the order."""
    keyed = _keyed(rows, rule)
    outcome = materialize(_outcome(keyed, rule, F.col("_seq")), "outcome")
    return _with_last(keyed, outcome, rule, (F.col("_own") == F.col("_key")) & (F.col("_seq") == F.col("_last")))


def upsert(base: DataFrame, incoming: DataFrame, rule: UpsertRule) -> DataFrame:
    """``base`` with the batch applied; ``base`` holds every key once.

    Written as a lookup of the batch from the table plus the rows of the batch that are new. The
    folded batch and the keys found in the table are stored: if they are small enough to be broadcast,
    which Spark decides from their measured size, no row or key of the table is shuffled, and
    otherwise once.
    """
    batch = materialize(fold_batch(incoming, rule), "folded")
    keyed = base.select("*", rule.key_struct().alias("_key"))
    new = batch.select("_key", F.struct(*rule.columns).alias("_new"))
    matched = materialize(keyed.select("_key").join(batch.select("_key"), "_key", "left_semi"), "matched")

    def merged(c: str) -> Column:
        if c in rule.keep:
            return column(c)
        if c in rule.fill:
            return F.coalesce(F.col(f"_new.{c}"), column(c)).alias(c)
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(column(c)).alias(c)

    updated = keyed.join(new, "_key", "left").select(*[merged(c) for c in rule.columns])
    inserted = batch.join(matched, "_key", "left_anti").select(*rule.columns)
    return updated.unionByName(inserted)
