"""A ledger of keys that were seen, for good: idempotency beyond a batch, a watermark and a restart.

Keys are kept in levelled runs, dealt by hash to partitions, each with a Bloom filter. A batch is held against the filters,
and only partitions whose filter hits are read. What a batch admitted stays with it, so a batch that is run again gets the
same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brontide.session import materialize
from brontide.sources import files, levels
from brontide.sources.levels import Run

_KEYS = "key string, a long, b long, part int"
_FILTERS = "bits long, at long, word long, part int"
_BITS_PER_KEY = 16


def _stage(keys: DataFrame, root: str, run: Run) -> None:
    """Keys and filters of a run, by partition."""
    path = f"{root}/keys/run={run.name}"
    keys.select("key", "a", "b", "part").repartition("part").write.partitionBy("part").parquet(path)
    stored = keys.sparkSession.read.schema(_KEYS).parquet(path)
    bits = F.expr(f"cast(power(2, ceil(log2(greatest(count(1) * {_BITS_PER_KEY}, 64)))) as long)")
    sizes = stored.groupBy("part").agg(bits.alias("bits"))
    places = stored.join(F.broadcast(sizes), "part").select("part", "bits", F.explode(levels.bit_positions("a", "b", "bits")).alias("place"))
    words = places.groupBy("part", "bits", F.expr("place div 64").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("word"))
    words.repartition("part").write.partitionBy("part").parquet(f"{root}/filters/run={run.name}")


def _read(spark: SparkSession, root: str, table: str, run: Run, schema: str, parts: list[int] | None = None) -> DataFrame:
    rows = spark.read.schema(schema).parquet(f"{root}/{table}/run={run.name}")
    return rows if parts is None else rows.filter(F.col("part").isin(parts))


def hits(spark: SparkSession, root: str, runs: list[Run], keys: DataFrame) -> DataFrame:
    """``run, part, a, key`` of the keys that a run's filter may hold. ``keys`` has ``key, a, b, part``."""
    # At most as many as there are partitions.
    parts = [r["part"] for r in keys.select("part").distinct().collect()]
    filters = None
    for run in runs:
        own = _read(spark, root, "filters", run, _FILTERS, parts).withColumn("run", F.lit(run.name))
        filters = own if filters is None else filters.unionByName(own)
    sizes = filters.select("run", "part", "bits").distinct()
    asked = keys.join(sizes, "part").select("run", "part", "a", "key", F.explode(F.array_distinct(levels.bit_positions("a", "b", "bits"))).alias("place"))
    asked = asked.withColumn("at", F.expr("place div 64"))
    found = asked.join(filters.drop("bits"), ["run", "part", "at"], "left")
    lit = F.coalesce(F.expr("word & shiftleft(1L, cast(place % 64 as int))") != 0, F.lit(False))
    return found.groupBy("run", "part", "a", "key").agg(F.min(lit.cast("int")).alias("all")).filter("all = 1").drop("all")


def known_keys(spark: SparkSession, root: str, runs: list[Run], found: DataFrame) -> DataFrame | None:
    """Keys of the partitions that hits name, and of no others; None if none do."""
    # At most a row per run and partition.
    places: dict[str, list[int]] = {}
    for r in found.select("run", "part").distinct().collect():
        places.setdefault(r["run"], []).append(r["part"])
    known = None
    for run in runs:
        if run.name in places:
            own = _read(spark, root, "keys", run, _KEYS, places[run.name]).select("a", "key")
            known = own if known is None else known.unionByName(own)
    return known


def admit(rows: DataFrame, root: str, batch: int, key: str = "idempotency_key", parts: int = 64, fanout: int = 8, keep: int = 10) -> DataFrame:
    """The rows of a batch whose key no earlier batch has brought; their keys are in the ledger from then on.

    ``rows`` has each key once, and batches come in the order of their numbers; the last one may come again, and then gets the
    rows it got before, whatever was written of them. A row without a key fails. ``parts`` must stay as it was first chosen.
    """
    spark = rows.sparkSession
    checked = F.coalesce(F.col(key).cast("string"), F.raise_error(F.lit(f"NULL in {key}")).cast("string"))
    stored = materialize(rows.withColumn("__key", checked), "ledger-batch")
    hashed = F.xxhash64(F.lit(1), "__key")
    keys = stored.select(F.col("__key").alias("key"), hashed.alias("a"), F.xxhash64(F.lit(2), "__key").alias("b"),
                         F.pmod(hashed, F.lit(parts)).cast("int").alias("part"))
    files.make_folder(spark, f"{root}/runs")
    while True:
        version, runs = levels.state(spark, root)
        own = [r for r in runs if r.upto == batch and r.level == 0]
        if own:
            mine = _read(spark, root, "keys", own[0], _KEYS).select(F.col("key").alias("__key"))
            return stored.join(mine, "__key", "left_semi").drop("__key")
        if runs and batch <= runs[-1].upto:
            raise ValueError(f"batch {batch} comes after batch {runs[-1].upto}")
        new = keys
        if runs:
            found = materialize(hits(spark, root, runs, keys), "ledger-hits")
            known = known_keys(spark, root, runs, found)
            if known is not None:
                again = known.join(found.select("a", "key").distinct(), ["a", "key"], "left_semi")
                new = keys.join(again, ["a", "key"], "left_anti")
        new = materialize(new, "ledger-new")
        staged = []
        # Runs are merged before the newest is added, so that it stays apart for a repetition of its batch.
        while old := levels.due(runs, fanout):
            runs, run = levels.merged(runs, old)
            together = None
            for x in old:
                part = _read(spark, root, "keys", x, _KEYS)
                together = part if together is None else together.unionByName(part)
            _stage(together, root, run)
            staged.append(run)
        run = levels.new_run(0, batch, batch)
        _stage(new, root, run)
        done = levels.commit(spark, root, version, [*runs, run])
        levels.discard(spark, root, ["keys", "filters"], [*staged, run], [*runs, run] if done else [])
        if done:
            levels.prune(spark, root, ["keys", "filters"], keep)
            return stored.join(new.select(F.col("key").alias("__key")), "__key", "left_semi").drop("__key")
