"""Ranked lexical search with per-term geometric blocking.

Documents become sparse vectors of integer term weights over the terms of a bounded block of items. Tasks read the
vectors in shards of a bounded size. In a shard each posting list is clustered by the similarity of its documents into
blocks, each with a summary: the largest weight of every term among its documents. An item walks the lists of its
terms from the shortest on. A block is scored exactly unless its summary, as a document of its own, could not
reach the item's k-th best; the walk ends when no document of the lists left could.

Every sum is of whole numbers below 2^53 and so exact in doubles; where they could be larger, 64-bit integers are used.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from brontide.llm.common import chunks, give_back
from brontide.llm.terms import raw_texts, terms
from brontide.session import materialize


@dataclass(frozen=True)
class Settings:
    """``items`` and ``item_terms`` bound a block of items, ``rows`` and ``postings`` a shard of documents in a task."""

    k: int = 20
    block: int = 64
    sketch: int = 16
    items: int = 2_000
    item_terms: int = 200_000
    rows: int = 20_000
    postings: int = 2_000_000
    seed: int = 11


@dataclass
class Walked:
    """What a search looked at: blocks whose summaries were held against a bound, and those of them it scored."""

    blocks: int = 0
    scored: int = 0
    lists: int = 0


@dataclass
class Items:
    """A block of items: sparse rows of term counts. ``order`` of a term is its place among terms from rare to frequent."""

    keys: list
    starts: np.ndarray
    terms: np.ndarray
    counts: np.ndarray
    weights: np.ndarray
    docs: int
    length: int
    by_term: list[list[int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.by_term = [[] for _ in self.weights]
        for i in range(len(self.keys)):
            for t in self.terms[self.starts[i]:self.starts[i + 1]]:
                self.by_term[t].append(i)


def _spread(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the entries of the rows of a sparse matrix, one row after the other, and where each row begins."""
    sizes = starts[rows + 1] - starts[rows]
    first = np.concatenate(([0], np.cumsum(sizes)))
    return np.arange(first[-1]) - np.repeat(first[:-1] - starts[rows], sizes), first


class Shard:
    """The blocked posting lists of some documents, of which each has an entry at least. ``places`` order equal scores."""

    def __init__(self, lengths: np.ndarray, starts: np.ndarray, cols: np.ndarray, tfs: np.ndarray, places: np.ndarray, items: Items, s: Settings) -> None:
        self.s, self.items, self.starts, self.cols, self.places = s, items, starts, cols, places
        most = int(lengths.max(initial=0))
        if 25 * most * max(items.docs, 1) < 1 << 62:
            share = 25 * lengths * items.docs // max(items.length, 1)
        else:
            share = np.array([25 * int(n) * items.docs // items.length for n in lengths], np.int64)
        damp = np.repeat(100 - 25 + share, np.diff(starts))
        values = items.weights[cols] * (1_000_000_000 * tfs // (1000 * tfs + 12 * damp))
        longest = int(np.add.reduceat(items.counts, items.starts[:-1]).max(initial=0)) if len(items.counts) else 0
        self.exact = int(values.max(initial=0)) * longest < 1 << 53
        self.values = values.astype(np.float64) if self.exact else values
        # Documents by term.
        self.rows = np.repeat(np.arange(len(lengths)), np.diff(starts))
        by_term = np.argsort(cols, kind="stable")
        self.posted = self.rows[by_term]
        self.lists = np.searchsorted(cols[by_term], np.arange(len(items.weights) + 1))
        self.highest = np.zeros(len(items.weights), self.values.dtype)
        np.maximum.at(self.highest, cols, self.values)
        self._sketch()

    def _sketch(self) -> None:
        """Documents as unit vectors of a few dimensions, that keep their angles roughly."""
        directions = np.random.default_rng(self.s.seed).normal(size=(len(self.items.weights), self.s.sketch))
        self.sketches = np.zeros((len(self.starts) - 1, self.s.sketch))
        for a in range(0, len(self.sketches), 2000):
            b = min(a + 2000, len(self.sketches))
            at = slice(self.starts[a], self.starts[b])
            weighted = directions[self.cols[at]] * np.asarray(self.values[at], np.float64)[:, None]
            self.sketches[a:b] = np.add.reduceat(weighted, self.starts[a:b] - self.starts[a], axis=0)
        self.sketches /= np.maximum(np.linalg.norm(self.sketches, axis=1, keepdims=True), 1e-300)

    def _blocks(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents of a list, block after block, and where each block begins."""
        docs, size = self.posted[self.lists[term]:self.lists[term + 1]], self.s.block
        if len(docs) <= size:
            return docs, np.zeros(1, np.int64)
        picked = np.random.default_rng([self.s.seed, term]).choice(len(docs), -(-len(docs) // size), replace=False)
        near = np.concatenate([np.argmax(self.sketches[docs[a:a + 4096]] @ self.sketches[docs[picked]].T, axis=1) for a in range(0, len(docs), 4096)])
        order = np.argsort(near, kind="stable")
        first = np.flatnonzero(np.diff(near[order], prepend=-1))
        # A cluster of many documents is cut, so that no block holds more than four times its share.
        return docs[order], np.concatenate([np.arange(a, b, 4 * size) for a, b in zip(first, [*first[1:], len(docs)])])

    def _summaries(self, docs: np.ndarray, first: np.ndarray, column: np.ndarray, width: int) -> np.ndarray:
        """The largest value of each column among a block's documents; ``column`` of a term is below 0 where it is left out."""
        at, _ = _spread(self.starts, docs)
        block = np.repeat(np.repeat(np.arange(len(first)), np.diff(first, append=len(docs))), self.starts[docs + 1] - self.starts[docs])
        own = column[self.cols[at]]
        keep = own >= 0
        out = np.zeros(len(first) * width, self.values.dtype)
        np.maximum.at(out, block[keep] * width + own[keep], self.values[at[keep]])
        return out.reshape(len(first), width)

    def search(self, best: list[list[tuple]], key_of, walked: Walked) -> None:
        """Brings ``best``, the k best of each item so far as (-score, place, key), up to date."""
        items, k = self.items, self.s.k
        n_terms, n_items = len(items.weights), len(items.keys)
        sizes = np.diff(self.lists)
        order = np.argsort(sizes, kind="stable")
        place = np.empty(n_terms, np.int64)
        place[order] = np.arange(n_terms)
        # For each item: its terms from the shortest list on, and what the lists from each on can give at most.
        own, left = [], []
        for i in range(n_items):
            at = slice(items.starts[i], items.starts[i + 1])
            by = np.argsort(place[items.terms[at]])
            t, c = items.terms[at][by], items.counts[at][by].astype(self.values.dtype)
            own.append((t, c))
            left.append(np.cumsum((self.highest[t] * c)[::-1])[::-1])
        step = np.zeros(n_items, np.int64)
        done = np.zeros(n_items, bool)
        dense = np.zeros(n_terms, self.values.dtype)
        column = np.full(n_terms, -1)
        found = [[np.zeros(0, self.values.dtype), np.zeros(0, np.int64)] for _ in range(n_items)]
        floor = np.array([-b[k - 1][0] if len(b) >= k else 0 for b in best], self.values.dtype)
        for term in order:
            walkers = []
            for i in items.by_term[term]:
                if not done[i]:
                    if sizes[term] and left[i][step[i]] >= max(floor[i], 1):
                        walkers.append(i)
                    elif left[i][step[i]] < max(floor[i], 1):
                        done[i] = True
                    step[i] += 1
            if not walkers:
                continue
            walked.lists += 1
            docs, first = self._blocks(term)
            ends = np.append(first[1:], len(docs))
            terms_left = np.unique(np.concatenate([own[i][0][step[i] - 1:] for i in walkers]))
            column[terms_left] = np.arange(len(terms_left))
            summaries = self._summaries(docs, first, column, len(terms_left))
            for i in walkers:
                t, c = own[i]
                bounds = summaries[:, column[t[step[i] - 1:]]] @ c[step[i] - 1:]
                walked.blocks += len(bounds)
                dense[t] = c
                # Blocks of high bounds first, some at a time, as they raise the floor for the others.
                by = np.argsort(-bounds, kind="stable")
                at = 0
                while at < len(by) and bounds[by[at]] >= max(floor[i], 1):
                    some = by[at:at + 8]
                    some = some[bounds[some] >= max(floor[i], 1)]
                    at += 8
                    walked.scored += len(some)
                    rows = np.concatenate([docs[first[b]:ends[b]] for b in some])
                    spots, begin = _spread(self.starts, rows)
                    scores = np.add.reduceat(self.values[spots] * dense[self.cols[spots]], begin[:-1])
                    hold = scores >= max(floor[i], 1)
                    if hold.any():
                        scores, rows = np.concatenate((found[i][0], scores[hold])), np.concatenate((found[i][1], rows[hold]))
                        rows, pick = np.unique(rows, return_index=True)
                        keep = np.lexsort((self.places[rows], -scores[pick]))[:k]
                        found[i] = [scores[pick][keep], rows[keep]]
                        if len(keep) == k:
                            floor[i] = max(floor[i], found[i][0][-1])
                dense[t] = 0
            column[terms_left] = -1
        for i, (scores, rows) in enumerate(found):
            if len(rows):
                best[i] = sorted([*best[i], *((-int(x), *key_of(r)) for x, r in zip(scores, rows))])[:k]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items with their terms and counts."""
    for batch in batches:
        out = []
        for raw in raw_texts(batch.column(1)):
            own: Counter = Counter()
            for part in terms(raw):
                own.update(part)
            out.append([{"term": t.decode(), "n": n} for t, n in own.items()])
        kind = pa.list_(pa.struct([("term", pa.string()), ("n", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["item", "terms"])


def _item_blocks(items: DataFrame, s: Settings) -> tuple[int, str]:
    """A number of blocks none of which has twice the set bounds, or more than one item, and the block of an item."""
    total = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("t")).first()
    n = max(1, -(-total["n"] // s.items), -(-total["t"] // s.item_terms))
    while True:
        block = f"pmod(xxhash64(item), {n})"
        sizes = items.groupBy(F.expr(block).alias("block")).agg(F.count("*").alias("n"), F.sum(F.size("terms")).alias("t"))
        if not sizes.filter((F.col("n") > 1) & ((F.col("n") > 2 * s.items) | (F.col("t") > 2 * s.item_terms))).limit(1).count():
            return n, block
        n *= 2


def _vectors(rows: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``key``, ``n`` (terms with repeats), ``ids`` and ``tfs`` of each document with a term."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    schema = T.StructType([rows.schema["key"], *T.StructType.fromDDL("n long, ids array<int>, tfs array<long>").fields])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {w: i for i, w in enumerate(shared.value)}
        for batch in batches:
            start = 0
            for some in chunks(batch.column(1)):
                sizes, ids, tfs, ends = [], [], [], [0]
                for raw in raw_texts(some):
                    own: Counter = Counter()
                    n = 0
                    for part in terms(raw):
                        n += len(part)
                        own.update(part)
                        if len(own) > 200_000:
                            own = Counter({w: c for w, c in own.items() if w in index})
                    for w in own.keys() & index.keys():
                        ids.append(index[w])
                        tfs.append(own[w])
                    sizes.append(n)
                    ends.append(len(ids))
                offsets = pa.array(ends, pa.int32())
                out = [batch.column(0).slice(start, len(some)), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                       pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))]
                start += len(some)
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return rows.mapInArrow(count, schema).filter("n > 0")


def _shards(batches: Iterator[pa.RecordBatch], items: Items, s: Settings) -> Iterator[tuple[Shard, pa.Array]]:
    """Shards of documents with a term of the block, with their keys."""
    held: list[pa.Table] = []

    def close() -> tuple[Shard, pa.Array]:
        table = pa.concat_tables(held).combine_chunks()
        held.clear()
        column = lambda name: table.column(name).combine_chunks() if table.column(name).num_chunks != 1 else table.column(name).chunk(0)
        keys, ids = column("key"), column("ids")
        places = np.empty(len(keys), np.int64)
        places[pc.sort_indices(keys, sort_keys=[("", "ascending")], null_placement="at_end").to_numpy()] = np.arange(len(keys))
        starts = np.concatenate(([0], np.cumsum(pc.list_value_length(ids).to_numpy())))
        return Shard(column("n").to_numpy(), starts, ids.flatten().to_numpy(), column("tfs").flatten().to_numpy(), places, items, s), keys

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table.filter(pc.greater(pc.list_value_length(table.column("ids")), 0))
        for a in range(0, len(table), 2000):
            held.append(table.slice(a, 2000))
            if sum(map(len, held)) >= s.rows or sum(len(x.column("ids").combine_chunks().flatten()) for x in held) >= s.postings:
                yield close()
    if sum(map(len, held)):
        yield close()


def search_shards(batches: Iterator[pa.RecordBatch], items: Items, s: Settings, walked: Walked | None = None) -> list[list[tuple]]:
    """The k best documents of each item among the vectors as (-score, null key, key)."""
    best: list[list[tuple]] = [[] for _ in items.keys]
    walked = walked if walked is not None else Walked()
    for shard, keys in _shards(batches, items, s):
        def key_of(row: int, keys=keys) -> tuple:
            key = keys[row].as_py()
            return key is None, 0 if key is None else key
        shard.search(best, key_of, walked)
    return best


def rank(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
         settings: Settings = Settings()) -> DataFrame:
    """``item``'s key, ``rank`` from 1, the document's key and ``score``: the k highest scores above 0 of each item.

    Scores are those of the contract of ``op11``, in whole numbers. Equal scores are ordered by ascending key, null keys
    last; rows of equal key are documents of their own. Rows of one item id are one item, with the terms of all of its
    different texts. Null texts and texts without terms neither rank nor count; items without terms give no rows.
    Other columns are not looked at. Without documents or items there are no rows.
    """
    s, spark = settings, docs.sparkSession
    asked = items.select(F.col(item_key).alias("item"), F.col(item_text).cast("string").alias("text")).dropDuplicates()
    schema = T.StructType([asked.schema["item"], *T.StructType.fromDDL("terms array<struct<term: string, n: long>>").fields])
    each = asked.mapInArrow(_counted, schema).select("item", F.explode("terms").alias("t")).groupBy("item", "t.term").agg(F.sum("t.n").alias("n"))
    asked = materialize(each.groupBy("item").agg(F.collect_list(F.struct("term", "n")).alias("terms")), "items")
    n_blocks, block = _item_blocks(asked, s)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    out = T.StructType([asked.schema["item"], rows.schema["key"], T.StructField("score", T.LongType())])
    found: list[DataFrame] = []
    for i in range(n_blocks):
        own = asked.filter(F.expr(block) == i).orderBy("item").collect()
        vocabulary = sorted({t["term"].encode() for r in own for t in r["terms"]})
        index = {w: i for i, w in enumerate(vocabulary)}
        vectors = materialize(_vectors(rows, vocabulary), "term-vectors")
        total = vectors.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
        weight = F.floor(1000 * F.log(F.lit(2.0 * total["n"] + 2) / (2 * F.col("count") + 1)))
        held = vectors.select(F.explode("ids").alias("id")).groupBy("id").count().select("id", weight.alias("w")).collect()
        weights = np.zeros(len(vocabulary), np.int64)
        for r in held:
            weights[r["id"]] = r["w"]
        each_terms = [sorted((index[t["term"].encode()], t["n"]) for t in r["terms"]) for r in own]
        shared = spark.sparkContext.broadcast(Items(
            [r["item"] for r in own], np.concatenate(([0], np.cumsum([len(x) for x in each_terms]))).astype(np.int64),
            np.array([t for x in each_terms for t, _ in x], np.int64), np.array([n for x in each_terms for _, n in x], np.int64),
            weights, total["n"], total["l"]))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best = search_shards(batches, shared.value, s)
            flat = [(item, None if b[1] else b[2], -b[0]) for item, own in zip(shared.value.keys, best) for b in own]
            give_back()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[j] for x in flat], kind) for j, kind in enumerate(arrow_types)], names=["item", "key", "score"])

        from pyspark.sql.pandas.types import to_arrow_type

        arrow_types = [to_arrow_type(f.dataType) for f in out.fields]
        best = materialize(vectors.mapInArrow(search, out), "lexical")
        order = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key")))
        found.append(best.withColumn("rank", order).filter(F.col("rank") <= s.k))
    ranked = found[0]
    for x in found[1:]:
        ranked = ranked.unionByName(x)
    # Whatever the keys are called, the document's keeps its name unless both have the same.
    name = key if key.lower() != item_key.lower() else f"{key}_found"
    return ranked.select(F.col("item").alias(item_key), F.col("rank").cast("int").alias("rank"), F.col("key").alias(name), "score")
