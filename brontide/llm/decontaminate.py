"""Benchmark decontamination by a generalised suffix automaton over the words of the test items.

The automaton holds every run of consecutive words of every item. The words of a document are streamed through it;
after each the state stands for the longest run of words up to there that some item also has. Where that run is long
enough its words are a span to be removed, and the state tells which items it comes from. Items shorter than
a window count where the whole item occurs.

Items are cut into overlapping pieces and these dealt to shards of a bounded number of words. Workers build the automaton
of a shard from its words, a few hundred kilobytes that are broadcast; each shard is one pass over the documents without a
shuffle. Only with more than one shard are texts with hits joined, by the digest of the text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from brontide.llm.common import chunks, give_back
from brontide.llm.terms import folded, raw_texts, terms
from brontide.session import materialize

_TERM = re.compile(rb"[^ ]+")
_SPANS = "array<struct<start: long, end: long>>"


@dataclass(frozen=True)
class Limits:
    """``window`` words in a row are a hit; a document of which more than ``coverage`` is hit goes as a whole.

    ``shard_words`` bounds the words of a shard in expectation and, doubled, for certain; a worker holds some 400 bytes a
    word. ``piece_words`` bounds the piece of an item, and with it the longest match that is told.
    """

    window: int = 10
    coverage: float = 0.5
    shard_words: int = 200_000
    piece_words: int = 20_000


class Automaton:
    """A suffix automaton of several word sequences: state 0 is the empty run; ``link`` leads to the longest run that
    ends alike and occurs elsewhere too, ``length`` is the longest run of a state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int) -> None:
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            state = 0
            for word in words:
                state = self._extend(state, word)
        # Items by the state of each of their windows, which is one state per window; shorter items by state and length.
        self.items: dict[int, set[str | None]] = {}
        self.short: dict[int, dict[int, set[str | None]]] = {}
        self.least = window
        for item, words in items:
            if words and len(words) < window:
                state = self._state_of(self._walk(words), len(words))
                self.short.setdefault(state, {}).setdefault(len(words), set()).add(item)
                self.least = min(self.least, len(words))
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i + 1 >= window:
                    self.items.setdefault(self._state_of(state, window), set()).add(item)

    def _new(self, length: int, link: int = 0, onward: dict[bytes, int] | None = None) -> int:
        self.next.append(onward if onward is not None else {})
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, state: int, word: bytes, target: int) -> int:
        """The runs of ``target`` that ``state`` and its suffixes reach by ``word`` as a state of their own."""
        own = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = own
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = own
            state = self.link[state]
        return own

    def _extend(self, last: int, word: bytes) -> int:
        target = self.next[last].get(word)
        if target is not None:
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        new = self._new(self.length[last] + 1)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            target = self.next[last][word]
            self.link[new] = target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        return new

    def _walk(self, words: list[bytes]) -> int:
        state = 0
        for word in words:
            state = self.next[state][word]
        return state

    def _state_of(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of a run that ``state`` stands for."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def match(self, parts: Iterator[list[bytes]]) -> tuple[int, list[tuple[int, int]], int, set[str | None]]:
        """Number of words, spans of hit words in order and apart, the longest match, and the items that occur."""
        next_, link, length, window, least = self.next, self.link, self.length, self.window, self.least
        state = run = longest = n = 0
        spans: list[tuple[int, int]] = []
        found: set[str | None] = set()
        seen: set[int] = set()
        for words in parts:
            for n, word in enumerate(words, n + 1):
                target = next_[state].get(word)
                if target is not None:
                    state = target
                    run += 1
                elif state:
                    while target is None and state:
                        state = link[state]
                        target = next_[state].get(word)
                    if target is None:
                        run = 0
                    else:
                        run = length[state] + 1
                        state = target
                if run > longest:
                    longest = run
                if run < least:
                    continue
                hit = 0
                if run >= window:
                    hit = run
                    at = self._state_of(state, window)
                    if at not in seen:
                        seen.add(at)
                        found |= self.items[at]
                if self.short:
                    at = state
                    while at > 0:
                        for size, own in self.short.get(at, {}).items():
                            if size <= run:
                                hit = max(hit, size)
                                found |= own
                        at = link[at]
                if hit:
                    start = n - hit
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, n))
        return n, spans, longest, found


def _pieces(benchmark: DataFrame, item_key: str, text: str, limits: Limits) -> DataFrame:
    """``item`` and ``words``, joined by blanks, of each piece; neighbours share all but one word of a window."""
    step = limits.piece_words - limits.window + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, out = [], []
            for item, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                own = [w for part in terms(raw) for w in part]
                for i in range(0, max(1, len(own) - limits.window + 1), step):
                    if own:
                        items.append(item)
                        out.append(b" ".join(own[i:i + limits.piece_words]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(out, pa.binary())], names=["item", "words"])

    rows = benchmark.select(F.col(item_key).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return materialize(rows.mapInArrow(cut, "item string, words binary").dropDuplicates(), "benchmark-pieces")


def _shards(pieces: DataFrame, limits: Limits) -> tuple[int, Column]:
    """A number of shards none of which has twice ``shard_words`` words, or more than one piece, and the shard of a piece."""
    size = F.length("words") - F.length(F.translate(F.col("words").cast("string"), " ", "")) + 1
    total = pieces.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-total // limits.shard_words))
    while True:
        shard = F.pmod(F.xxhash64("item", "words"), F.lit(n)).cast("int")
        sizes = pieces.groupBy(shard.alias("shard")).agg(F.sum(size).alias("words"), F.count("*").alias("pieces"))
        if not sizes.filter((F.col("words") > 2 * limits.shard_words) & (F.col("pieces") > 1)).limit(1).count():
            return n, shard
        n *= 2


_built: dict[str, Automaton] = {}


def _automaton(name: str, rows: list[tuple[str | None, bytes]], window: int) -> Automaton:
    """One automaton per worker process, kept from task to task."""
    if name not in _built:
        _built.clear()
        give_back()
        _built[name] = Automaton([(item, words.split(b" ")) for item, words in rows], window)
    return _built[name]


def _matched(df: DataFrame, text: str, rows: list[tuple[str | None, bytes]], limits: Limits) -> DataFrame:
    """``df`` with ``__n_words``, ``__spans``, ``__longest`` and ``__items`` of one shard."""
    shared, name = df.sparkSession.sparkContext.broadcast(rows), uuid.uuid4().hex
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL(
        f"__n_words long, __spans {_SPANS}, __longest int, __items array<string>, __hit boolean").fields])
    at = df.columns.index(text)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, shared.value, limits.window)
        for batch in batches:
            start = 0
            for some in chunks(batch.column(at)):
                out = [automaton.match(terms(raw)) for raw in raw_texts(some)]
                spans = pa.array([[{"start": a, "end": b} for a, b in x[1]] for x in out],
                                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
                new = [pa.array([x[0] for x in out], pa.int64()), spans, pa.array([x[2] for x in out], pa.int32()),
                       pa.array([sorted(i for i in x[3] if i is not None) for x in out], pa.list_(pa.string())),
                       pa.array([bool(x[1]) for x in out])]
                rest = batch.slice(start, len(some))
                start += len(some)
                yield pa.RecordBatch.from_arrays([*rest.columns, *new], names=schema.names)

    return df.mapInArrow(match, schema)


def _merged(spans: Column) -> Column:
    """Spans in order, those that touch or overlap as one."""
    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["start"]),
                      F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(x)))
    return F.aggregate(F.array_sort(spans), F.array().cast(_SPANS), add)


def _found(df: DataFrame, benchmark: DataFrame, text: str, item_key: str, item_text: str, limits: Limits) -> DataFrame:
    pieces = _pieces(benchmark, item_key, item_text, limits)
    n, shard = _shards(pieces, limits)
    rows_of = lambda i: [(r["item"], bytes(r["words"])) for r in pieces.filter(shard == i).orderBy("item", "words").collect()]
    found = _matched(df, text, rows_of(0), limits)
    if n == 1:
        return found
    # Equal texts have equal hits, so those of the other shards are joined by the text's digest.
    digest = F.sha2(F.col(text), 256)
    texts, more = df.select(F.col(text).alias("__text")), []
    for i in range(1, n):
        hits = _matched(texts, "__text", rows_of(i), limits).filter("__hit")
        more.append(materialize(hits.select(F.sha2("__text", 256).alias("__digest"), "__spans", "__longest", "__items")
                                    .dropDuplicates(["__digest"]), "benchmark-hits"))
    rest = more[0]
    for x in more[1:]:
        rest = rest.unionByName(x)
    rest = rest.groupBy("__digest").agg(F.flatten(F.collect_list("__spans")).alias("__more_spans"), F.max("__longest").alias("__more_longest"),
                                        F.flatten(F.collect_list("__items")).alias("__more_items"))
    both = found.withColumn("__digest", digest).join(rest, "__digest", "left")
    none = lambda name, kind: F.coalesce(F.col(name), F.array().cast(kind))
    return both.withColumns({
        "__spans": _merged(F.concat("__spans", none("__more_spans", _SPANS))),
        "__longest": F.greatest("__longest", "__more_longest"),
        "__items": F.array_sort(F.array_distinct(F.concat("__items", none("__more_items", "array<string>"))))}
    ).withColumn("__hit", F.size("__spans") > 0)


def _n_hit() -> Column:
    return F.aggregate("__spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
         item_text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """A row per row of ``docs``: key, ``n_words``, ``n_hit``, ``longest`` (words of the longest match), ``items`` (ids as
    strings, sorted), ``spans`` of hit words and ``contaminated``.

    Null and empty texts have no words; items without words never occur; items without an id mark words and are not
    listed, items of one id are one. Rows with equal or null keys are rows of their own; other columns are not
    looked at. Without items nothing is hit; an empty table gives no rows. ``longest`` is exact up to ``piece_words``.
    """
    rows = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    found = _found(rows, benchmark, "__text", item_key, item_text, limits)
    return found.select(F.col("__key").alias(key), F.col("__n_words").alias("n_words"), _n_hit().alias("n_hit"), F.col("__longest").alias("longest"),
                        F.col("__items").alias("items"), F.col("__spans").alias("spans"), F.col("__hit").alias("contaminated"))


def without_spans(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the bytes from the first to the last word of each span."""
    out, left, n, at, start = [], 0, 0, 0, None
    for offset, part in folded(raw):
        for word in _TERM.finditer(part):
            if at < len(spans) and n == spans[at][0]:
                start = offset + word.start()
            n += 1
            if start is not None and n == spans[at][1]:
                out.append(raw[left:start])
                left, start, at = offset + word.end(), None, at + 1
    return b"".join([*out, raw[left:]])


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
          limits: Limits = Limits()) -> DataFrame:
    """``docs`` with hit spans cut out of their texts, without documents of which more than ``coverage`` of the words is hit.

    Columns and all other texts stay as they are, null and empty ones too. See ``find`` for odd rows.
    """
    # Own names, so that no column of the caller's gets in the way.
    names = [f"__c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)
    found = _found(docs.toDF(*names), benchmark, names[at], item_key, item_text, limits)
    found = found.filter(_n_hit() <= F.lit(limits.coverage) * F.col("__n_words"))
    schema = T.StructType([*docs.toDF(*names).schema.fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for some in chunks(batch.column(at)):
                spans = batch.column(len(names)).slice(start, len(some)).to_pylist()
                out = [raw if not own else without_spans(raw, [(x["start"], x["end"]) for x in own])
                       for raw, own in zip(raw_texts(some), spans)]
                columns = [c.slice(start, len(some)) for c in batch.columns[:len(names)]]
                columns[at] = pa.array(out, pa.large_binary()).cast(pa.large_string()).cast(pa.string())
                start += len(some)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return found.select(*names, "__spans").mapInArrow(cut, schema).toDF(*docs.columns)
