"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens; only longer ones are cut. The pieces are dealt at
random to pools of a bounded size, all alike in their lengths. For each pool several islands evolve
populations of packings: crossover injects whole well-filled bins of one parent into the other,
removes the bins that hold injected pieces a second time, and puts the displaced pieces where they fit
best. Between epochs each island passes its best packing to the next. The best of all islands is used.
Pools are independent, so the work is spread by pool and island, and is linear in the pieces.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from brontide.llm.common import chunks, give_back, mix, power
from brontide.session import materialize


class _Table:
    """Numbers by 64-bit hash, found and added many at a time; a table of fixed size, probed in line."""

    BITS = 21

    def __init__(self) -> None:
        self.keys, self.at = np.zeros(1 << self.BITS, np.uint64), np.zeros(1 << self.BITS, np.int32)
        self.size, self.mask = 0, (1 << self.BITS) - 1

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers, -1 where there is none; no hash is 0."""
        out, todo, slots = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), self._slots(hashes)
        while len(todo):
            there = self.keys[slots[todo]]
            hit = there == hashes[todo]
            out[todo[hit]] = self.at[slots[todo[hit]]]
            todo = todo[~hit & (there != 0)]
            slots[todo] = (slots[todo] + 1) & self.mask
        return out

    def add(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """For distinct hashes that are not there."""
        todo, slots = np.arange(len(hashes)), self._slots(hashes)
        self.size += len(hashes)
        while len(todo):
            free = todo[self.keys[slots[todo]] == 0]
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            self.keys[slots[placed]], self.at[slots[placed]] = hashes[placed], numbers[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            slots[todo] = (slots[todo] + 1) & self.mask


def _word_hashes(words: pa.StringArray) -> np.ndarray:
    """Hashes of the bytes of words without empty ones."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    starts, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    sums = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power("up", int(sizes.max()))[place], starts)
    hashes = mix(sums + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.where(hashes == 0, np.uint64(1), hashes)


class WordCache:
    """Token ids by word of text, for a tokenizer that never joins across white space.

    The ids of a text are those of its words. A word of Latin letters and punctuation behind them is its stem in
    lower case and its tail, as the tokenizer lowers case and splits there too; new stems are encoded many
    at a time, and told apart by the end that the vocabulary marks on the last token of a word. Any other
    word is encoded as it is. Words are known by 64-bit hashes, so that a million of them take some tens of
    megabytes. What is kept is bounded; beyond, the cache starts anew.
    """

    MOST_WORDS, MOST_PARTS, MOST_CHARS, AT_ONCE = 800_000, 250_000, 5_000_000, 500

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        # One for both, with its normalizer taken off for stems: a second one would be as large again in every task.
        self.tokenizer = Tokenizer.from_str(definition)
        self.normalizer = self.tokenizer.normalizer
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        self.words = _Table()
        self.size, self.used = 0, 0
        self.starts, self.lengths = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)
        self.ids = np.zeros(1 << 14, np.uint16 if len(self.ends) <= 1 << 16 else np.uint32)
        self._forget_parts()

    def _forget_parts(self) -> None:
        self.parts: dict[str, int] = {}
        self.chars = 0
        self._keep([""], np.zeros(0, np.uint32), np.zeros(1, np.int64), self.parts)

    def _keep(self, names: list[str], flat: np.ndarray, lengths: np.ndarray, into: dict[str, int] | None = None) -> np.ndarray:
        """Stores ids one after the other; returns the number of each."""
        n, first, count = self.size, self.used, len(lengths)
        while len(self.starts) < n + count:
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while len(self.ids) < first + len(flat):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.starts[n:n + count] = first + np.cumsum(lengths) - lengths
        self.lengths[n:n + count] = lengths
        self.ids[first:first + len(flat)] = flat
        self.size, self.used = n + count, first + len(flat)
        if into is not None:
            into.update(zip(names, range(n, self.size)))
            self.chars += sum(map(len, names))
        return np.arange(n, self.size)

    def _gather(self, index: np.ndarray) -> np.ndarray:
        lengths = self.lengths[index].astype(np.int64)
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[index] - ends + lengths, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.ids[at].astype(np.uint32)

    def _encode_stems(self, stems: list[str]) -> None:
        for i in range(0, len(stems), self.AT_ONCE):
            some = stems[i:i + self.AT_ONCE]
            self.tokenizer.normalizer = None
            flat = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            self.tokenizer.normalizer = self.normalizer
            last = np.flatnonzero(self.ends[flat])
            if len(last) == len(some):
                self._keep(some, flat, np.diff(np.concatenate(([-1], last))), self.parts)
            else:
                self._encode_others(some)

    def _encode_others(self, words: list[str]) -> None:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        self._keep(words, np.fromiter(chain.from_iterable(encoded), np.uint32), np.fromiter(map(len, encoded), np.int64, len(words)), self.parts)

    def _add(self, words: list[str], hashes: np.ndarray) -> np.ndarray:
        if len(self.parts) > self.MOST_PARTS or self.chars > self.MOST_CHARS:
            self._forget_parts()
        split, stems, others = [], {}, {}
        for word in words:
            stem = word.rstrip(string.punctuation)
            if stem.isalpha() and (stem.isascii() or max(stem) < "\u0250"):
                tail, stem = word[len(stem):], stem.lower()
                if not stem.isalpha():  # a capital that becomes a letter with a mark
                    stem, tail = word, ""
                    others[word] = None
                elif stem not in self.parts:
                    stems[stem] = None
                if tail not in self.parts:
                    others[tail] = None
            else:
                stem, tail = word, ""
                if word not in self.parts:
                    others[word] = None
            split += (stem, tail)
        self._encode_stems(list(stems))
        if others:
            self._encode_others(list(others))
        index = np.fromiter(map(self.parts.__getitem__, split), np.int64, len(split))
        numbers = self._keep(words, self._gather(index), self.lengths[index].reshape(-1, 2).sum(axis=1, dtype=np.int64))
        self.words.add(hashes, numbers)
        return numbers

    def encode_all(self, texts: pa.StringArray) -> Iterator[np.ndarray]:
        """Ids of each text; the texts together should be a few million characters at most."""
        if self.words.size > self.MOST_WORDS or self.used > 16 * self.MOST_WORDS:
            self.clear()
        split = pc.ascii_split_whitespace(texts)
        words, sizes = split.flatten(), pc.list_value_length(split).to_numpy()
        # White space at an end leaves an empty word; it has no ids.
        there = pc.binary_length(words).to_numpy() > 0
        counts = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[there], minlength=len(sizes))
        encoded = words.filter(pa.array(there)).dictionary_encode()
        distinct = encoded.dictionary
        hashes = _word_hashes(distinct) if len(distinct) else np.zeros(0, np.uint64)
        own = self.words.find(hashes)
        new = np.flatnonzero(own < 0)
        if len(new):
            own[new] = self._add(distinct.take(pa.array(new)).to_pylist(), hashes[new])
        index = own[encoded.indices.to_numpy()]
        flat = self._gather(index)
        upto = np.concatenate(([0], np.cumsum(self.lengths[index], dtype=np.int64)))[np.concatenate(([0], np.cumsum(counts)))]
        return (flat[a:b] for a, b in zip(upto[:-1], upto[1:]))


def token_pieces(docs: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id",
                 capacity: int = 4096, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """A row per piece: key, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if wanted, ``ids``.

    A null text counts as empty: one piece with the end id alone. Every row of the input gives its own
    pieces, also where keys are null or repeat. The tokenizer's file is read once, on the driver.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())]
                          + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of this task, and freed with it.
        cache = WordCache(definition.value)
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            texts = (some.cast(pa.string()).fill_null("") for some in chunks(batch.column(1), 2_000_000))
            for i, ids in enumerate(chain.from_iterable(map(cache.encode_all, texts))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    for column, v in zip(rows, (i, piece, start, len(part), zlib.crc32(part.tobytes()),
                                                part.astype(np.int32) if keep_ids else None)):
                        column.append(v)
            columns = [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()),
                       *[pa.array(rows[k], pa.int64()) for k in (2, 3, 4)]]
            if keep_ids:
                columns.append(pa.array(rows[5], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])
        del cache
        give_back()

    return docs.select(key, text).mapInArrow(cut, schema)


@dataclass(frozen=True)
class Evolution:
    """``pool`` is the number of pieces that are packed together, as an expectation."""

    pool: int = 16_000
    islands: int = 2
    population: int = 4
    generations: int = 12
    epochs: int = 2
    seed: int = 1


class _Bins:
    """Bins under construction, found by the room they have left: one bit per amount of room."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.mask = capacity, 0
        self.members: list[list[int]] = []
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, members: list[int], room: int) -> None:
        self.members.append(members)
        self.open[room].append(len(self.members) - 1)
        self.mask |= 1 << room

    def best_fit(self, item: int, length: int) -> None:
        fits = self.mask >> length
        if not fits:
            self.add([item], self.capacity - length)
            return
        room = length + (fits & -fits).bit_length() - 1
        own = self.open[room]
        b = own.pop()
        if not own:
            self.mask &= ~(1 << room)
        self.members[b].append(item)
        self.open[room - length].append(b)
        self.mask |= 1 << (room - length)


Packing = list[list[int]]


def best_fit(order: list[int], lengths: list[int], capacity: int, bins: _Bins | None = None) -> Packing:
    bins = bins or _Bins(capacity)
    for i in order:
        bins.best_fit(i, lengths[i])
    return bins.members


def crossover(a: Packing, b: Packing, lengths: list[int], capacity: int, random: np.random.Generator) -> Packing:
    """``a`` with some of the best-filled bins of ``b`` in it."""
    loads = np.array([sum(lengths[i] for i in members) for members in b])
    # Well filled: no worse than the median; about half of those are injected, whole.
    well = np.flatnonzero(loads >= np.median(loads))
    injected = [b[k] for k in well[random.random(len(well)) < random.uniform(0.2, 0.6)]]
    taken = set(chain.from_iterable(injected))
    bins, displaced = _Bins(capacity), []
    for members in injected:
        bins.add(list(members), capacity - sum(lengths[i] for i in members))
    for members in a:
        if taken.isdisjoint(members):
            bins.add(list(members), capacity - sum(lengths[i] for i in members))
        else:
            displaced += [i for i in members if i not in taken]
    displaced.sort(key=lambda i: -lengths[i])
    return best_fit(displaced, lengths, capacity, bins)


def mutate(a: Packing, lengths: list[int], capacity: int, random: np.random.Generator) -> Packing:
    """``a`` with its worst bins and a few others emptied and their pieces placed anew."""
    loads = np.array([sum(lengths[i] for i in members) for members in a])
    gone = set(np.argsort(loads, kind="stable")[:max(2, len(a) // 20)]) | set(random.integers(0, len(a), max(2, len(a) // 20)))
    bins, displaced = _Bins(capacity), []
    for k, members in enumerate(a):
        if k in gone:
            displaced += members
        else:
            bins.add(list(members), capacity - int(loads[k]))
    displaced.sort(key=lambda i: -lengths[i])
    return best_fit(displaced, lengths, capacity, bins)


def fitness(a: Packing, lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones: the mean square of their fill."""
    fill = [sum(lengths[i] for i in members) / capacity for members in a]
    return -len(a), float(np.mean(np.square(fill))) if fill else 0.0


def evolve(population: list[Packing], lengths: list[int], capacity: int, s: Evolution,
           random: np.random.Generator) -> list[Packing]:
    """The population after an epoch, best first. Without any, it starts from best fits of the
    pieces in falling length, jittered for all but the first. Ends where no packing can be better."""
    least = -(-sum(lengths) // capacity)
    size = np.array(lengths, float)
    while len(population) < s.population and not (population and len(population[0]) <= least):
        jitter = random.normal(0, 0.08 if population else 0.0, len(size))
        population.append(best_fit(np.argsort(-size * (1 + jitter), kind="stable").tolist(), lengths, capacity))
    rank = lambda p: fitness(p, lengths, capacity)
    scored = sorted(((rank(p), p) for p in population), key=lambda x: x[0], reverse=True)[:s.population]
    for _ in range(s.generations):
        if len(scored[0][1]) <= least or len(scored) < 2:
            break
        i, j = sorted(random.choice(len(scored), 2, replace=False))
        child = crossover(scored[i][1], scored[j][1], lengths, capacity, random)
        if random.random() < 0.5:
            child = mutate(child, lengths, capacity, random)
        scored = sorted([*scored, (rank(child), child)], key=lambda x: x[0], reverse=True)[:s.population]
    return [p for _, p in scored]


def _labels(packing: Packing, n: int) -> np.ndarray:
    out = np.zeros(n, np.int32)
    for b, members in enumerate(packing):
        out[members] = b
    return out


def _bins_of(labels: np.ndarray) -> Packing:
    order = np.argsort(labels, kind="stable")
    cuts = np.flatnonzero(np.diff(labels[order])) + 1
    return [part.tolist() for part in np.split(order, cuts)] if len(labels) else []


_STATE = "pool long, island int, lengths array<int>, best array<int>, bins int, fill double, others array<array<int>>"


def _epoch(capacity: int, s: Evolution, epoch: int):
    def run(pool: int, island: int, lengths: np.ndarray, population: list[Packing]) -> dict:
        random = np.random.default_rng([s.seed, epoch, pool, island])
        sizes = lengths.tolist()
        packings = evolve(population, sizes, capacity, s, random)
        bins, fill = fitness(packings[0], sizes, capacity)
        labels = [_labels(p, len(sizes)) for p in packings]
        return {"pool": pool, "island": island, "lengths": lengths, "best": labels[0], "bins": -bins, "fill": fill,
                "others": [list(x) for x in labels[1:]]}
    return run


def pack(items: DataFrame, capacity: int = 4096, length: str = "length", settings: Evolution = Evolution()) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``, their place in sequences of at most ``capacity``.

    Every row is an item, equal ones too; lengths must be from 1 to the capacity, anything else
    fails. Full items are sequences of their own. Other columns pass through; those named like the two
    new ones are replaced. An empty table gives no rows. Re-runs on the same files agree.
    """
    items = items.drop("sequence_id", "offset")
    right = F.col(length).between(1, capacity)
    checked = F.when(F.coalesce(right, F.lit(False)), F.col(length)).otherwise(
        F.raise_error(F.concat(F.lit("length out of range: "), F.coalesce(F.col(length).cast("string"), F.lit("null")))))
    # Written once, so that the random numbers are the same for all that follows.
    items = materialize(items.withColumn("__length", checked.cast("int")).withColumn("__u", F.rand(settings.seed)), "pack-items")
    partial = items.filter(F.col("__length") < capacity)
    pools = max(1, -(-partial.count() // settings.pool))
    pool = F.floor(F.col("__u") * pools).cast("long").alias("pool")
    first = _epoch(capacity, settings, 0)

    def start(key: tuple, rows: pa.Table) -> pa.Table:
        lengths = np.sort(rows.column("__length").to_numpy())[::-1].astype(np.int32)
        return pa.Table.from_pylist([first(key[0].as_py(), key[1].as_py(), lengths, [])], schema=arrow_state)

    arrow_state = pa.schema([("pool", pa.int64()), ("island", pa.int32()), ("lengths", pa.list_(pa.int32())),
                             ("best", pa.list_(pa.int32())), ("bins", pa.int32()), ("fill", pa.float64()),
                             ("others", pa.list_(pa.list_(pa.int32())))])
    islands = F.explode(F.sequence(F.lit(0), F.lit(settings.islands - 1))).alias("island")
    state = materialize(partial.select(pool, "__length", islands).groupBy("pool", "island").applyInArrow(start, _STATE), "pack-state")
    for epoch in range(1, settings.epochs):
        step = _epoch(capacity, settings, epoch)
        guests = state.select("pool", ((F.col("island") + 1) % settings.islands).alias("island"), F.col("best").alias("guest"))

        def go_on(batches: Iterator[pd.DataFrame], step=step) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame([step(r.pool, r.island, np.asarray(r.lengths, np.int32),
                                         [_bins_of(np.asarray(x)) for x in [r.best, r.guest, *r.others]])
                                    for r in batch.itertuples()],
                                   columns=["pool", "island", "lengths", "best", "bins", "fill", "others"])

        state = materialize(state.join(guests, ["pool", "island"]).mapInPandas(go_on, _STATE), "pack-state")
    best = state.groupBy("pool").agg(F.min_by("best", F.struct("bins", -F.col("fill"), "island")).alias("best"))
    keep = [f for f in items.schema if not f.name.startswith("__")]
    schema = T.StructType([*keep, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = [f.name for f in keep]

    def place(key: tuple, rows: pa.Table, packing: pa.Table) -> pa.Table:
        lengths = rows.column("__length").to_numpy()
        order = np.argsort(-lengths, kind="stable")
        labels = np.asarray(packing.column("best")[0].as_py() if len(packing) else [], np.int64)
        by_bin = np.argsort(labels, kind="stable")
        ends = np.cumsum(lengths[order][by_bin])
        begins = ends - lengths[order][by_bin]
        firsts = np.flatnonzero(np.concatenate(([True], np.diff(labels[by_bin]) != 0)))
        offsets = begins - np.repeat(begins[firsts], np.diff(np.append(firsts, len(begins))))
        out = rows.select(names).take(pa.array(order[by_bin]))
        out = out.append_column("sequence_id", pa.array((key[0].as_py() << 32) + labels[by_bin], pa.int64()))
        return out.append_column("offset", pa.array(offsets, pa.int64()))

    dealt = partial.withColumn("__pool", pool).groupBy("__pool")
    placed = dealt.cogroup(best.withColumnRenamed("pool", "__pool").groupBy("__pool")).applyInArrow(place, schema)
    # Full items go to no pool, however many they are.
    alone = items.filter(F.col("__length") == capacity).select(
        *[F.col(f"`{c}`") for c in names], (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(alone)
