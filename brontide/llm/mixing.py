"""Mixing sources to target weights by capped water-filling, with seeded repetitions.

Every source gets a share of all words in proportion to its weight, but at most ``max_epochs`` times its
own words. What clamped sources cannot use goes to the others in proportion to their weights, until no
target is above its cap. A source is then repeated whole as often as its target holds it, and the
rest is taken from its documents in the order of a seeded digest: each that fits into what is still missing, and one
more where that brings the source nearer to its target. So it ends within half of its smallest document that is left.

No document is moved. Up to the first document that does not fit, a source takes all it may; where that is, is found from a
histogram of digests and the documents of one of its 4096 buckets. It goes on behind that document with those no larger than
what is missing, for all sources at once, and the gap falls to some fraction each time. In the end a few ranges of digests
and sizes tell for every document whether it is taken; a source with a third of all rows is spread over all tasks, as any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brontide.llm.common import WORD, replace_columns
from brontide.session import materialize


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _digest(key: str, text: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")),
                             F.coalesce(F.col(text), F.lit(""))).cast("binary"))


def water_level(sources: DataFrame) -> float:
    """The words per unit of weight at which the targets add up to all sizes.

    ``sources`` has ``size``, ``cap`` and ``weight``. Each round clamps the sources that the level lifts
    above their caps, and shares what is left among the others. The level only rises, so clamped
    sources stay clamped, and a round is one aggregation.
    """
    level, clamped = 0.0, -1
    while True:
        over = F.lit(level) * F.col("weight") > F.col("cap")
        r = sources.agg(F.sum("size").alias("total"), F.count(F.when(over, 1)).alias("clamped"),
                        F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)).alias("used"),
                        F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
        if r["clamped"] == clamped or not r["weight"] or not r["total"]:
            return level
        level, clamped = (r["total"] - r["used"]) / r["weight"], r["clamped"]


def source_plan(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
                weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3, seed: int = 10, rounds: int = 64) -> DataFrame:
    """A row per source: its words, target, whole repetitions, and the ``ranges`` and ``filler`` of the partial one.

    Sources are weighed by turns in the order of their code points, null last. Rows equal in key and text are taken together or
    not at all. After ``rounds`` documents of a source that did not fit, the next one ends it.
    """
    rows = docs.select(F.col(source).cast("string").alias("source"), n_words(text).alias("size"),
                       _digest(key, text, seed).alias("digest"))
    # One narrow scan of the texts; all that follows reads this table, a row per digest.
    units = materialize(rows.groupBy("source", "digest").agg(F.max("size").alias("size"), F.sum("size").alias("words")), "mix-units")
    buckets = units.groupBy("source").agg(F.sum("words").alias("words"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    sizes = buckets.groupBy("source").agg(F.sum("words").alias("size"))
    sources = sizes.select("source", "size", (F.col("size") * max_epochs).alias("cap"),
                           F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1).alias("weight"))
    sources = materialize(sources, "mix-sources")
    level = water_level(sources)
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))
    plan = sources.withColumn("target", target)
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0)
    plan = plan.withColumn("whole", F.least(whole, F.lit(max_epochs)).cast("int"))
    plan = plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("size"))

    plan = materialize(plan, "mix-targets")
    gaps = materialize(plan.filter("rest > 0").select("source", F.col("rest").alias("gap"), F.lit("").alias("after")), "mix-gaps")
    found = []
    for i in range(rounds):
        step = materialize(_fitting(units, gaps), "mix-round")
        found.append(step.select("source", F.struct(F.lit(i).alias("round"), "after", "until", F.col("gap").alias("most")).alias("range"),
                                 (F.col("gap") - F.col("got")).alias("gap")))
        # Sources that met a document that does not fit and may still take others.
        gaps = step.filter("until is not null and gap > got").select("source", (F.col("gap") - F.col("got")).alias("gap"), F.col("until").alias("after"))
        if not gaps.limit(1).count():
            break
    ranges = found[0]
    for more in found[1:]:
        ranges = ranges.unionByName(more)
    ranges = materialize(ranges.groupBy("source").agg(F.array_sort(F.collect_list("range")).alias("ranges"), F.min("gap").alias("gap")), "mix-ranges")
    # One more, if it brings the source nearer to its target.
    off = F.abs(F.col("words") - F.col("gap"))
    left = units.join(ranges, _same(units, ranges)).drop(ranges["source"]).filter(F.col("words") > 0).filter(~_taken("digest", "size", "ranges")).filter(off < F.col("gap"))
    filler = left.groupBy("source").agg(F.min_by("digest", F.struct(off, "digest")).alias("filler"))
    plan = plan.join(ranges, _same(plan, ranges), "left").drop(ranges["source"])
    plan = plan.join(filler, _same(plan, filler), "left").drop(filler["source"])
    return materialize(plan.select("source", F.col("size").alias("source_size"), "target", "whole", "ranges", "filler"), "mix-plan")


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["source"])


def _taken(digest: str, size: str, ranges: str) -> Column:
    """Whether a document is in one of the ranges: behind ``after``, before ``until``, and of ``most`` words at most."""
    inside = F.exists(ranges, lambda r: (F.col(digest) > r["after"]) & (r["until"].isNull() | (F.col(digest) < r["until"])) & (F.col(size) <= r["most"]))
    return F.coalesce(inside, F.lit(False))


def _fitting(units: DataFrame, gaps: DataFrame) -> DataFrame:
    """For each source of ``gaps`` the first digest ``until`` behind ``after`` whose words, of those no larger than the gap, do not
    fit any more, null if all do, and the words ``got`` of those before it."""
    able = units.join(gaps, _same(units, gaps)).drop(gaps["source"]).filter("digest > after and size <= gap")
    able = able.select("source", "digest", "words", "gap")
    buckets = materialize(able.groupBy("source", F.substring("digest", 1, 3).alias("bucket")).agg(F.sum("words").alias("words"), F.first("gap").alias("gap")), "mix-buckets")
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    summed = buckets.withColumn("upto", upto).withColumn("over", F.col("upto") > F.col("gap"))
    # The bucket in which the words get too many, and the words before it.
    edges = materialize(summed.filter("over and upto - words <= gap").select("source", "bucket", (F.col("upto") - F.col("words")).alias("before")), "mix-edges")
    inside = able.join(edges, _same(able, edges) & (F.substring(able["digest"], 1, 3) == edges["bucket"])).drop(edges["source"])
    running = Window.partitionBy("source").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    ends = (inside.withColumn("upto", F.col("before") + F.sum("words").over(running)).filter("upto > gap")
                  .groupBy("source").agg(F.min("digest").alias("until"), F.min("upto").alias("upto"), F.min_by("words", "digest").alias("words")))
    ends = ends.select("source", "until", (F.col("upto") - F.col("words")).alias("got"))
    whole = buckets.groupBy("source").agg(F.sum("words").alias("all"))
    out = gaps.join(ends, _same(gaps, ends), "left").drop(ends["source"]).join(whole, _same(gaps, whole), "left").drop(whole["source"])
    return out.select("source", "gap", "after", "until", F.coalesce("got", "all", F.lit(0)).alias("got"))


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
        weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3, seed: int = 10) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``repeats``, the times the mix takes each.

    A null text has no words. Documents without words are repeated like others of their digest and add
    nothing; null sources are one source. Equal rows get equal repeats. The same rows and seed give the
    same mix in any order. Columns named like the new ones are replaced; an empty table gives no rows.
    """
    plan = source_plan(docs, text, key, source, weights, max_epochs, seed)
    plan = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    found = docs.withColumn("__digest", _digest(key, text, seed)).withColumn("__size", n_words(text))
    found = found.join(plan, F.col(source).cast("string").eqNullSafe(F.col("__source")))
    again = _taken("__digest", "__size", "__ranges") | F.coalesce(F.col("__digest") == F.col("__filler"), F.lit(False))
    out = replace_columns(found, {"size": F.col("__size"), "source_size": F.col("__source_size"),
                                  "target": F.col("__target"), "repeats": F.col("__whole") + again.cast("int")})
    return out.drop("__digest", "__size", *plan.columns)


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """Each row as often as ``repeats`` says, at most the number of epochs; rows with 0 or null go. An empty table stays empty."""
    return (mixed.filter("repeats > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("repeats"))))
                 .drop("__copy", "repeats"))
