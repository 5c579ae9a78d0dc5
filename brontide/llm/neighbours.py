"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Vectors are projected to a few dimensions by Gaussian directions. For a pair at distance s the squared
projected distance is s^2 times a chi-square variable. A kd-tree over the projections hands out neighbours in
the order of their projected distance; each is verified on the original vectors, until a point as near
as the k-th best found would, with the set confidence, have shown up already.

Rows are dealt to ranges of one kd-tree over the projections of a bounded sample, in shards of a bounded size. A query
is first answered in its own range; the distance of its k-th best found there leaves out every other range whose box
the stopping test would not enter. So rows move once per block of the queries that come to their range, and on
vectors with any structure most queries come to few. Where all distances are nearly equal the test never holds, and every
range is looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from brontide.session import materialize, small_frame


@dataclass(frozen=True)
class Search:
    """``dimensions`` is even, so that the chi-square distribution is a finite sum. ``rows`` and ``queries`` bound a group;
    ``sample`` bounds the rows that the ranges are found on, ``ranges`` their number."""

    k: int = 10
    dimensions: int = 8
    leaf: int = 64
    confidence: float = 0.95
    rows: int = 20_000
    queries: int = 2_000
    sample: int = 16_384
    ranges: int = 1_024
    seed: int = 7


def chi_square(x: float, dimensions: int) -> float:
    """Distribution function for an even number of dimensions."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, dimensions // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total if half < 700 else 1.0


def out_of_reach(bound: float, last: float, s: Search) -> bool:
    """The stopping test: whether points from a squared projected distance of ``bound`` on need no verification, as one as near as
    ``last`` would, with the set confidence, have been projected nearer."""
    if bound <= 0 or last == math.inf:
        return False
    return last == 0 or chi_square(bound / (last * last), s.dimensions) >= s.confidence


def directions(size: int, s: Search) -> np.ndarray:
    return np.random.default_rng([s.seed, size]).normal(size=(size, s.dimensions))


class Ranges:
    """A kd-tree that cuts the space of projections into at most ``n`` ranges of about as many of its points."""

    def __init__(self, points: np.ndarray, n: int, first: int = 0) -> None:
        self.nodes: list[tuple] = []
        self.first, self.n = first, 0
        self._cut(points, n)

    def _cut(self, points: np.ndarray, n: int) -> int:
        own = len(self.nodes)
        self.nodes.append(())
        spread = np.ptp(points, axis=0) if len(points) else np.zeros(1)
        axis = int(np.argmax(spread))
        at = np.sort(points[:, axis])[len(points) * (n // 2) // n] if n > 1 and spread[axis] > 0 else 0.0
        left = points[:, axis] < at if n > 1 and spread[axis] > 0 else np.zeros(len(points), bool)
        if not left.any():
            # A range of its own: few points, or most of them equal.
            self.nodes[own] = (-1, self.first + self.n, -1, -1)
            self.n += 1
        else:
            low = self._cut(points[left], n // 2)
            self.nodes[own] = (axis, at, low, self._cut(points[~left], n - n // 2))
        return own

    def of(self, points: np.ndarray) -> np.ndarray:
        """The number of the range of each point."""
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            axis, value, low, high = self.nodes[node]
            if axis < 0:
                out[at] = value
            elif len(at):
                left = points[at, axis] < value
                todo += [(low, at[left]), (high, at[~left])]
        return out


class ProjectedTree:
    """A kd-tree over the projections of distinct vectors, each with the ids that have it.

    An id may have several vectors, but each of them once.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, s: Search) -> None:
        self.s = s
        order = np.argsort(ids, kind="stable")
        self.vectors, inverse = np.unique(vectors[order], axis=0, return_inverse=True)
        by_vector = np.argsort(inverse.ravel(), kind="stable")
        self.ids = ids[order][by_vector]
        self.first = np.searchsorted(inverse.ravel()[by_vector], np.arange(len(self.vectors) + 1))
        self.directions = directions(vectors.shape[1], s)
        points = self.vectors @ self.directions
        # Nodes are (low corner, high corner, positions or None, left, right).
        self.nodes: list[tuple] = []
        self._build(points, np.arange(len(points)))

    def _build(self, points: np.ndarray, at: np.ndarray) -> int:
        low, high = points[at].min(axis=0), points[at].max(axis=0)
        own = len(self.nodes)
        self.nodes.append(())
        if len(at) <= self.s.leaf or not (high > low).any():
            self.nodes[own] = (low, high, at, -1, -1)
        else:
            axis = int(np.argmax(high - low))
            halves = at[np.argsort(points[at, axis], kind="stable")]
            middle = len(halves) // 2
            left, right = self._build(points, halves[:middle]), self._build(points, halves[middle:])
            self.nodes[own] = (low, high, None, left, right)
        return own

    def nearest(self, query: np.ndarray, own: int, limit: float = math.inf) -> list[tuple[float, int]]:
        """Distances and ids of the k nearest found, without the query's own id; none beyond ``limit``, at which k are known."""
        k, projected, known = self.s.k, query @ self.directions, limit

        def to(node: int) -> float:
            low, high = self.nodes[node][:2]
            gap = np.maximum(np.maximum(low - projected, projected - high), 0.0)
            return float(gap @ gap)

        heap, best = [(to(0), 0)], []
        while heap:
            bound, node = heapq.heappop(heap)
            if out_of_reach(bound, min(known, best[-1][0]) if len(best) == k else known, self.s):
                break
            _, _, at, left, right = self.nodes[node]
            if at is None:
                heapq.heappush(heap, (to(left), left))
                heapq.heappush(heap, (to(right), right))
                continue
            difference = self.vectors[at] - query
            distances = np.sqrt(np.einsum("ij,ij->i", difference, difference))
            limit = min(known, best[-1][0]) if len(best) == k else known
            for i in np.flatnonzero(distances <= limit):
                # Of equal vectors the smallest ids; one more than k, as the query's own may be among them.
                start = self.first[at[i]]
                ids = self.ids[start:min(start + k + 1, self.first[at[i] + 1])]
                best += [(float(distances[i]), int(x)) for x in ids if x != own]
            # An id with several vectors takes one place, with the nearest.
            nearest_of: dict[int, float] = {}
            for distance, x in sorted(best):
                nearest_of.setdefault(x, distance)
            best = [(distance, x) for x, distance in nearest_of.items()][:k]
        return best


def usable(key: str, vector: str) -> Column:
    """Rows that take part: an id, and a vector that is not null, zero or empty and has finite numbers only."""
    cells = F.col(vector).cast("array<double>")
    finite = F.forall(cells, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.col(key).isNotNull() & F.coalesce(finite & F.exists(cells, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", search: Search = Search()) -> DataFrame:
    """``query_id``, ``rank`` from 1, the neighbour's key and ``score``, its Euclidean distance, for each query.

    ``queries`` and ``vectors`` have the same columns; other columns are not looked at. A query's own id
    is no candidate; vectors of another length than the query's are none either. Rows that are not
    ``usable`` take no part. Ties go to the smaller id; an id that repeats counts once, with its
    nearest vector. Empty tables give no rows.
    """
    s = search
    cells = F.col(vector).cast("array<double>").alias("v")
    distinct = lambda df: materialize(df.filter(usable(key, vector)).select(F.col(key).cast("long").alias("id"), cells)
                                      .dropDuplicates().withColumn("size", F.size("v")), "vectors")
    rows, asked = distinct(vectors), distinct(queries)
    ranges = _find_ranges(rows, s)
    placed, asked = (materialize(_placed(df, ranges, s), "placed") for df in (rows, asked))
    # A row per range: its shards, and the box of its projections.
    boxes = placed.groupBy("range", "size").agg(F.count("*").alias("n"), *[f(F.col("point")[i]).alias(f"{f.__name__}{i}")
                                                                         for i in range(s.dimensions) for f in (F.min, F.max)]).collect()
    extent = {r["range"]: (r["size"], np.array([r[f"min{i}"] for i in range(s.dimensions)]), np.array([r[f"max{i}"] for i in range(s.dimensions)])) for r in boxes}
    shards = small_frame(vectors.sparkSession, [{"range": r["range"], "shards": -(-r["n"] // s.rows)} for r in boxes], T.StructType.fromDDL("range int, shards int"))
    shards = materialize(shards, "shards")
    dealt = placed.join(F.broadcast(shards), "range").select("id", "v", "range", F.pmod(F.xxhash64("id", "v", F.lit(s.seed)), F.col("shards")).cast("int").alias("shard"))
    dealt = materialize(dealt, "dealt")

    home = asked.select("id", "v", F.col("range"), F.lit(float("inf")).alias("limit"))
    near = materialize(_search(dealt, home, shards, s), "near")
    at_k = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    least = near.groupBy("query_id", "id").agg(F.min("score").alias("score")).withColumn("rank", at_k).filter(F.col("rank") == s.k)
    bounded = asked.join(least.select(F.col("query_id").alias("id"), F.col("score").alias("limit")), "id", "left")
    bounded = bounded.withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    far = materialize(_search(dealt, materialize(_others(bounded, extent, s), "others"), shards, s), "far")
    found = near.unionByName(far).groupBy("query_id", "id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= s.k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _find_ranges(rows: DataFrame, s: Search) -> dict[int, Ranges]:
    """For each length of vectors its ranges, numbered throughout; lengths are taken to be few."""
    out, first = {}, 0
    for size, n in sorted(tuple(r) for r in rows.groupBy("size").count().collect()):
        picked = rows.filter((F.col("size") == size) & (F.pmod(F.xxhash64("id", F.lit(s.seed)), F.lit(n)) < s.sample))
        sample = picked.select("v").orderBy(F.xxhash64("v")).limit(2 * s.sample).toArrow()
        points = _matrix(sample.column("v"), size) @ directions(size, s) if len(sample) else np.zeros((0, s.dimensions))
        out[size] = Ranges(points, min(s.ranges, -(-n // s.rows)), first)
        first += out[size].n
    return out


def _placed(df: DataFrame, ranges: dict[int, Ranges], s: Search) -> DataFrame:
    """``df`` with ``range`` and ``point``, the projection; vectors of a length that no row has are left out."""
    shared = df.sparkSession.sparkContext.broadcast(ranges)
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL("range int, point array<double>").fields])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                if int(size) in shared.value:
                    own = batch.filter(pa.array(sizes == size))
                    points = _matrix(own.column("v"), int(size)) @ directions(int(size), s)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * s.dimensions, pa.int32()), pa.array(points.ravel()))
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(shared.value[int(size)].of(points)), lists], names=schema.names)

    return df.mapInArrow(place, schema)


def _others(asked: DataFrame, extent: dict, s: Search) -> DataFrame:
    """``id, v, limit`` for each other range that a query has to look at."""
    shared = asked.sparkSession.sparkContext.broadcast(extent)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.array(sorted(shared.value))
        sizes = np.array([shared.value[n][0] for n in numbers])
        low, high = (np.array([shared.value[n][i] for n in numbers]).reshape(len(numbers), s.dimensions) for i in (1, 2))
        for batch in batches:
            at, to = [], []
            points = _matrix(batch.column("point"), s.dimensions)
            for i, (size, home, limit) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("size", "range", "limit")])):
                gap = np.maximum(np.maximum(low - points[i], points[i] - high), 0.0)
                for j, bound in enumerate(np.einsum("ij,ij->i", gap, gap)):
                    if numbers[j] != home and sizes[j] == size and not out_of_reach(float(bound), limit, s):
                        at.append(i)
                        to.append(numbers[j])
            some = batch.select(["id", "v", "limit"]).take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(to, pa.int32())], names=["id", "v", "limit", "range"])

    return asked.mapInArrow(reach, "id long, v array<double>, limit double, range int")


def _search(dealt: DataFrame, asked: DataFrame, shards: DataFrame, s: Search) -> DataFrame:
    """The nearest in each shard of the ranges that queries are sent to, in blocks of queries."""
    visits = asked.groupBy("range").agg(F.ceil(F.count("*") / s.queries).cast("int").alias("blocks"))
    # A row per range, at most ``s.ranges`` for each length.
    visits = materialize(visits.join(shards, "range"), "visits")
    keys = ["range", "shard", "block"]
    left = dealt.join(F.broadcast(visits.select("range", "blocks")), "range").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    right = asked.join(F.broadcast(visits), "range").withColumn("block", F.pmod(F.xxhash64("id", F.lit(s.seed)), F.col("blocks")).cast("int"))
    right = right.withColumn("shard", F.explode(F.expr("sequence(0, shards - 1)")))

    def search_block(have: pa.Table, want: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(have) and len(want):
            size = len(have.column("v")[0])
            tree = ProjectedTree(have.column("id").to_numpy(), _matrix(have.column("v"), size), s)
            for own, query, limit in zip(want.column("id").to_pylist(), _matrix(want.column("v"), size), want.column("limit").to_pylist()):
                out += [(own, x, d) for d, x in tree.nearest(query, own, limit)]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
                        names=["query_id", "id", "score"])

    pair = left.select(*keys, "id", "v").groupBy(*keys).cogroup(right.select(*keys, "id", "v", "limit").groupBy(*keys))
    return pair.applyInArrow(search_block, "query_id long, id long, score double")
