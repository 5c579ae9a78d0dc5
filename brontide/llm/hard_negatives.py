"""Hard negatives by shared candidate lists of anchor clusters.

Rows and anchors are clustered by angle around the same centres. For a cluster of anchors no row can score more with
a member than |member| |row| cos(angle between row and centre, less the widest angle of a member). Candidates are
sorted once by what does not depend on the member; each member walks that list until no later row could enter its
results, which certifies them.

Rows are dealt to shards of a bounded size within their cluster, anchors to bundles of a bounded number. A pair of a
bundle and a shard is a group of its own. First each bundle meets the shards of its own clusters; the scores found
there leave out every other shard whose centre, widest angle and largest norm cannot give a row that would enter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from brontide.session import materialize, small_frame

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
_WANTS = "array<struct<want: int, low: long, high: long, floor: long>>"
_FOUND = "anchor long, anchor_node long, want int, id long, node long, score long"


@dataclass(frozen=True)
class Mining:
    """A negative scores between ``low`` and ``high`` percent of a positive. ``sample`` bounds the rows the centres are found
    on; ``shard`` and ``bundle`` bound the rows and anchors of a group, fewer where vectors are longer than 200."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    rows_per_centre: int = 2_000
    centres: int = 256
    sample: int = 16_384
    shard: int = 20_000
    bundle: int = 512
    seed: int = 12


def quantised(vector: str, scale: float = 256.0) -> Column:
    return F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * scale).cast("long"))


def _usable(key: str, label: str, vector: str) -> Column:
    cells = F.col(vector).cast("array<double>")
    finite = F.forall(cells, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(finite & (F.size(cells) > 0), F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and unit vectors; a zero vector stays zero, at a right angle to all."""
    plain = vectors.astype(np.float64)
    norms = np.linalg.norm(plain, axis=1)
    return norms, plain / np.maximum(norms, 1e-300)[:, None]


def angles(units: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centre, -1.0, 1.0))


def find_centres(units: np.ndarray, n: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Centres of at most ``n`` clusters by angle."""
    distinct = np.unique(units, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.choice(len(distinct), min(n, len(distinct)), replace=False)]
    for _ in range(rounds):
        near = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, units)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-300), centres)
    return centres


class Wants:
    """What the members of a cluster look for: the ``k`` best rows of a score from ``low`` to ``high``, of the member's label
    or of another. Kept results are parallel arrays in no order."""

    def __init__(self, member: np.ndarray, low: np.ndarray, high: np.ndarray, floor: np.ndarray, k: int) -> None:
        self.member, self.low, self.high, self.k = member, low, high, k
        self.floor = np.maximum(low, floor)
        self.at = np.zeros(0, np.int64)
        self.score, self.id, self.node = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray, nodes: np.ndarray) -> None:
        at, score = np.concatenate((self.at, at)), np.concatenate((self.score, score))
        ids, nodes = np.concatenate((self.id, ids)), np.concatenate((self.node, nodes))
        order = np.lexsort((nodes, ids, ~score, at))
        at = at[order]
        first = np.searchsorted(at, at)
        keep = np.arange(len(at)) - first < self.k
        last = np.arange(len(at)) - first == self.k - 1
        order = order[keep]
        self.at, self.score, self.id, self.node = at[keep], score[order], ids[order], nodes[order]
        full = last[keep]
        self.floor[self.at[full]] = np.maximum(self.floor[self.at[full]], self.score[full])


def walk(members: dict[str, np.ndarray], wants: Wants, rows: dict[str, np.ndarray], centre: np.ndarray, same: bool) -> int:
    """Sorts ``rows`` once for the cluster and walks them for all members; how many scores were computed.

    Both have ``id``, ``label``, ``v`` (whole numbers) and ``node``.
    """
    norms, units = directions(members["v"])
    widest = float(angles(units, centre).max(initial=0.0)) if norms.all() else math.pi
    row_norms, row_units = directions(rows["v"])
    ahead = row_norms * np.cos(np.maximum(angles(row_units, centre) - widest - 1e-9, 0.0))
    order = np.argsort(-ahead, kind="stable")
    ahead = ahead[order]
    exact = norms.max(initial=0) * row_norms.max(initial=0) < 1 << 52
    kind = np.float64 if exact else np.int64
    left, right = members["v"].astype(kind), rows["v"][order].astype(kind)
    ids, nodes, labels = rows["id"][order], rows["node"][order], rows["label"][order]
    start, size, scored = 0, 256, 0
    while start < len(order):
        # The rest of the list gives a member at most this; one more for rounding.
        most = norms * ahead[start]
        going = np.flatnonzero(most[wants.member] * (1 + 1e-9) + 1 >= wants.floor)
        if not len(going):
            break
        active, column = np.unique(wants.member[going], return_inverse=True)
        part = slice(start, start + size)
        scores = (right[part] @ left[active].T).astype(np.int64)
        scored += scores.size
        fit = (labels[part][:, None] == members["label"][active]) == same
        fit &= ids[part][:, None] != members["id"][active]
        for a in range(0, len(going), 512):
            some, at = going[a:a + 512], column[a:a + 512]
            own = scores[:, at]
            row, hit = np.nonzero(fit[:, at] & (own >= wants.floor[some]) & (own <= wants.high[some]))
            if len(row):
                wants.add(some[hit], own[row, hit], ids[part][row], nodes[part][row])
        start, size = start + size, min(2 * size, 4096)
    return scored


def _placed(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """Rows with ``centre`` (numbered over all lengths), ``angle`` to it and ``norm``."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)
    first = dict(zip(sorted(centres), np.cumsum([0, *[len(centres[d]) for d in sorted(centres)]]).tolist()))
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("centre int, angle double, norm double").fields])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            near, angle, norm = np.zeros(len(sizes), np.int32), np.zeros(len(sizes)), np.zeros(len(sizes))
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                own = shared.value[int(size)]
                norm[at], units = directions(_matrix(batch.column("v").take(pa.array(at)), int(size)))
                cosine = units @ own.T
                pick = np.argmax(cosine, axis=1)
                near[at], angle[at] = first[int(size)] + pick, np.arccos(np.clip(cosine[np.arange(len(at)), pick], -1.0, 1.0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near), pa.array(angle), pa.array(norm)], names=schema.names)

    return rows.mapInArrow(place, schema)


@dataclass
class _Deal:
    """``rows`` with ``shard``, ``anchors`` with ``bundle``, and per centre its direction and extent."""

    rows: DataFrame
    anchors: DataFrame
    shards: DataFrame
    centres: list[np.ndarray]
    extent: dict[int, tuple[int, float, float]]


def _deal(rows: DataFrame, m: Mining) -> _Deal:
    spark = rows.sparkSession
    total = rows.groupBy("size").count().collect()
    centres: dict[int, np.ndarray] = {}
    for r in sorted(total):
        picked = rows.filter((F.col("size") == r["size"]) & (F.pmod(F.xxhash64("id", "node", F.lit(m.seed)), F.lit(r["count"])) < m.sample))
        sample = picked.select("v").orderBy(F.xxhash64("v")).limit(2 * m.sample).toArrow()
        n = min(m.centres, max(1, r["count"] // m.rows_per_centre))
        centres[r["size"]] = find_centres(directions(_matrix(sample.column("v"), r["size"]))[1], n, m.seed) if len(sample) else np.eye(1, r["size"])
    placed = materialize(_placed(rows, centres), "placed")
    stats = placed.groupBy("centre", "size").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("is_anchor"), 1)).alias("asked"), F.max("norm").alias("norm"), F.max("angle").alias("angle")).collect()
    dealt, shard, bundle, room = [], 0, 0, 0
    for r in sorted(stats):
        scale = max(1.0, r["size"] / 200)
        in_shard, in_bundle = max(1, int(m.shard / scale)), max(1, int(m.bundle / scale))
        shards, bundles = -(-r["n"] // in_shard), -(-r["asked"] // in_bundle)
        # Small clusters share a bundle with the one before.
        if bundles != 1 or room < r["asked"] or (dealt and dealt[-1]["size"] != r["size"]):
            bundle += dealt[-1]["bundles"] if dealt else 0
            room = in_bundle if bundles <= 1 else 0
        room -= r["asked"]
        dealt.append({"centre": r["centre"], "size": r["size"], "shard": shard, "shards": shards, "bundle": bundle, "bundles": max(1, bundles)})
        shard += shards
    salt = F.xxhash64("id", "node", F.lit(m.seed + 1))
    plan = small_frame(spark, dealt, T.StructType.fromDDL("centre int, size int, shard int, shards int, bundle int, bundles int"))
    placed = materialize(placed.join(F.broadcast(plan.drop("size")), "centre").withColumns({
        "shard": (F.col("shard") + F.pmod(salt, F.col("shards"))).cast("int"), "bundle": (F.col("bundle") + F.pmod(salt, F.col("bundles"))).cast("int")
    }).select("id", "node", "label", "v", "size", "centre", "angle", "norm", "is_anchor", "shard", "bundle"), "dealt")
    flat = [c for d in sorted(centres) for c in centres[d]]
    return _Deal(placed.select("id", "node", "label", "v", "shard"),
                 placed.filter("is_anchor").select("id", "node", "label", "v", "centre", "angle", "norm", "bundle"),
                 plan.select("centre", "size", F.explode(F.expr("sequence(shard, shard + shards - 1)")).alias("shard")),
                 flat, {r["centre"]: (r["size"], r["norm"], r["angle"]) for r in stats})


def _pairs(asked: DataFrame, deal: _Deal, home: bool) -> DataFrame:
    """``bundle`` and ``shard`` where a row may enter a result: of the own clusters, or of all others by the floors in ``asked``."""
    own = asked.select("bundle", "centre").distinct()
    if home:
        return own.join(deal.shards, "centre").select("bundle", "shard").distinct()
    floor = F.array_min(F.transform("wants", lambda w: F.greatest(w["low"], w["floor"])))
    parts = asked.groupBy("bundle", "centre").agg(F.min(floor).alias("floor"), F.max("norm").alias("norm"), F.max("angle").alias("angle"))
    shared = asked.sparkSession.sparkContext.broadcast((deal.centres, deal.extent))

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, extent = shared.value
        for batch in batches:
            out = []
            for r in batch.itertuples():
                size = extent[r.centre][0]
                for target, (other, norm, angle) in extent.items():
                    if other != size:
                        continue
                    apart = math.acos(min(1.0, max(-1.0, float(centres[r.centre] @ centres[target])))) - r.angle - angle - 1e-6
                    if max(0.0, math.cos(max(0.0, apart))) * r.norm * norm * (1 + 1e-9) + 1 >= r.floor:
                        out.append((r.bundle, target))
            yield pd.DataFrame(out, columns=["bundle", "centre"])

    far = parts.mapInPandas(reach, "bundle int, centre int").distinct().join(own, ["bundle", "centre"], "left_anti")
    return far.join(deal.shards, "centre").select("bundle", "shard").distinct()


def _search(asked: DataFrame, deal: _Deal, pairs: DataFrame, k: int, same: bool) -> DataFrame:
    """The ``k`` best rows of each want of ``asked`` within each of the pairs."""
    pairs = materialize(pairs, "pairs")
    shared = asked.sparkSession.sparkContext.broadcast(deal.centres)
    left = asked.join(pairs, "bundle").groupBy("bundle", "shard")
    right = deal.rows.join(pairs, "shard").groupBy("bundle", "shard")
    names = ["anchor", "anchor_node", "want", "id", "node", "score"]

    def search(want: pa.Table, have: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in names]
        if len(want) and len(have):
            size = len(have.column("v")[0])

            def arrays(t: pa.Table) -> dict[str, np.ndarray]:
                return {c: t.column(c).to_numpy() for c in ("id", "node", "label")} | {"v": _matrix(t.column("v"), size)}

            rows = arrays(have)
            of = want.column("centre").to_numpy()
            for centre in np.unique(of):
                own = want.filter(pa.array(of == centre))
                members, each = arrays(own), own.column("wants").combine_chunks()
                flat = each.flatten()
                field = lambda name: flat.field(name).to_numpy()
                wants = Wants(np.repeat(np.arange(len(own)), each.value_lengths().to_numpy()), field("low"), field("high"), field("floor"), k)
                walk(members, wants, rows, shared.value[centre], same)
                member = wants.member[wants.at]
                for column, values in zip(out, (members["id"][member], members["node"][member], field("want")[wants.at], wants.id, wants.node, wants.score)):
                    column.append(values)
        return pa.table([pa.array(np.concatenate(c)).cast(pa.int32() if n == "want" else pa.int64()) for n, c in zip(names, out)], names=names)

    return left.cogroup(right).applyInArrow(search, _FOUND)


def _best(asked: DataFrame, deal: _Deal, k: int, same: bool) -> DataFrame:
    """The ``k`` best rows of each want, ranked: first in the own clusters, then wherever the scores found there leave room."""
    order = F.row_number().over(Window.partitionBy("anchor", "anchor_node", "want").orderBy(F.desc("score"), "id", "node"))
    ranked = lambda df: df.withColumn("rank", order).filter(F.col("rank") <= k)
    near = materialize(_search(asked, deal, _pairs(asked, deal, True), k, same), "near")
    floors = ranked(near).filter(F.col("rank") == k).groupBy("anchor", "anchor_node").agg(
        F.map_from_entries(F.collect_list(F.struct("want", "score"))).alias("floors"))
    found = F.col("floors")
    raised = F.transform("wants", lambda w: F.struct(
        w["want"].alias("want"), w["low"].alias("low"), w["high"].alias("high"), F.coalesce(found[w["want"]], w["floor"]).alias("floor")))
    asked = materialize(asked.join(floors.withColumnsRenamed({"anchor": "id", "anchor_node": "node"}), ["id", "node"], "left")
                        .withColumn("wants", raised).drop("floors"), "floors")
    far = materialize(_search(asked, deal, _pairs(asked, deal, False), k, same), "far")
    return materialize(ranked(near.unionByName(far)), "ranked")


def mine(vectors: DataFrame, anchors: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding", mining: Mining = Mining()) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    Scores are inner products of the vectors' cells times 256, rounded down. The positives of an anchor, a row where
    ``anchors`` holds, are the best other rows of its label; the negatives of a positive are the best rows of other
    labels between ``low`` and ``high`` percent of its score. Ties go to the smaller key.

    Rows without a key, label or vector take no part, nor do empty vectors, those with a null or non-finite cell, and those
    whose rounded cells' squares add up to 2^62 or more, as scores then may not fit 64 bits. Rows equal in all three
    count once; a key with several vectors is several rows, none a positive or negative of another. Vectors of another
    length do not meet. Other columns are not looked at; empty tables, and positives without a negative, give no rows.
    """
    m = mining
    rows = vectors.filter(_usable(key, label, vector)).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), quantised(vector).alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    rows = rows.filter(square < float(1 << 62)).dropDuplicates(["id", "label", "v"])
    rows = materialize(rows.withColumns({"node": F.xxhash64("label", "v"), "size": F.size("v")}), "vectors")
    deal = _deal(rows, m)
    whole = F.array(F.struct(F.lit(0).alias("want"), F.lit(_LOW).alias("low"), F.lit(_HIGH).alias("high"), F.lit(_LOW).alias("floor"))).cast(_WANTS)
    positives = _best(materialize(deal.anchors.withColumn("wants", whole), "asked"), deal, m.positives, True)
    # low * p <= 100 * n <= high * p, in whole numbers.
    p = F.col("score").cast("decimal(38,0)")
    low, high = F.ceil(p * m.low / 100).cast("long"), F.floor(p * m.high / 100).cast("long")
    wants = positives.groupBy("anchor", "anchor_node").agg(F.collect_list(F.struct(
        F.col("rank").cast("int").alias("want"), low.alias("low"), high.alias("high"), F.lit(_LOW).alias("floor"))).cast(_WANTS).alias("wants"))
    asked = deal.anchors.join(wants.withColumnsRenamed({"anchor": "id", "anchor_node": "node"}), ["id", "node"])
    asked = materialize(asked.withColumn("wants", F.filter("wants", lambda w: w["low"] <= w["high"])).filter(F.size("wants") > 0), "asked")
    negatives = _best(asked, deal, m.negatives, False)
    of = positives.select("anchor", "anchor_node", F.col("rank").cast("int").alias("want"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(of, ["anchor", "anchor_node", "want"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
