"""Language-model scores from the lattice of all segmentations into subwords.

The pieces of an existing vocabulary and their scores give a first unigram distribution; one pass of
expectation-maximisation over the words of the training texts, each word weighted by its count, fits it to the
corpus. The probability of a text is the sum over all its segmentations, by a forward recursion in log space,
and a piece that ends the text. A piece never spans white space, so the lattice of a text is the chain of
the lattices of its words: each distinct word is evaluated once, in a table that grows with the corpus.

The most frequent words, of a bounded number, go to the tasks that read the texts; the other words of each
text are joined with the table.
"""

from __future__ import annotations

import math
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from brontide.llm.common import chunks, code_points, mix, power, span_hashes
from brontide.session import materialize

# Fixed value: the mark of white space before a word in the vocabulary.
GAP = "▁"
_NONE = float("-inf")


@dataclass(frozen=True)
class Settings:
    """``hot`` bounds the words that every task holds, ``hot_length`` their characters."""

    hot: int = 100_000
    hot_length: int = 64
    rounds: int = 1
    smoothing: float = 0.5


_SLOT_BITS = 20


def _slot(hashes: np.ndarray, which: int) -> np.ndarray:
    return (hashes >> np.uint64(44 - 22 * which)) & np.uint64((1 << _SLOT_BITS) - 1)


def _piece_hash(piece: str) -> np.uint64:
    codes = code_points(piece)
    return span_hashes(codes, np.array([0]), np.array([len(codes)]))[0]


@dataclass
class Vocabulary:
    """Pieces with their log probabilities, in a dictionary that also has their prefixes, as -1.

    ``index`` leads to ``logs``; the positions from ``len(pieces)`` on are the 256 bytes, which stand in
    for characters without a piece, and last the end of a text.
    """

    pieces: list[str]
    logs: np.ndarray

    def __post_init__(self) -> None:
        self.index = {p[:n]: -1 for p in self.pieces for n in range(1, len(p))}
        self.index.update({p: i for i, p in enumerate(self.pieces)})
        self.values = self.logs.tolist()

        # Pieces by a 64-bit hash in two tables; the few whose slot in the first is taken are in the second.
        self.longest = max(map(len, self.pieces), default=1)
        hashes = np.array([_piece_hash(p) for p in self.pieces], np.uint64)
        self.slots, self.names = np.zeros((2, 1 << _SLOT_BITS), np.uint64), np.full((2, 1 << _SLOT_BITS), -1, np.int64)
        for which in (0, 1):
            left = np.flatnonzero(~np.isin(np.arange(len(hashes)), self.names))
            slots, first = np.unique(_slot(hashes[left], which), return_index=True)
            self.slots[which, slots], self.names[which, slots] = hashes[left[first]], left[first]
        # What even the second has no room for goes by the dictionary.
        self.crowded = len(np.setdiff1d(np.arange(len(hashes)), self.names)) > 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the pieces with these hashes, -1 where there is none."""
        out = np.full(len(hashes), -1, np.int64)
        for which in (0, 1):
            slot = _slot(hashes, which)
            hit = self.slots[which, slot] == hashes
            out[hit] = self.names[which, slot[hit]]
        return out

    @property
    def end(self) -> float:
        return self.values[-1]

    def steps(self, word: str, i: int) -> list[tuple[int, float, tuple[int, ...]]]:
        """Stop, log probability and positions of the steps through a word from one place on."""
        index, values, out, single = self.index, self.values, [], False
        for j in range(i + 1, len(word) + 1):
            at = index.get(word[i:j])
            if at is None:
                break
            if at >= 0:
                single = single or j == i + 1
                out.append((j, values[at], (at,)))
        if not single:
            at_bytes = tuple(len(self.pieces) + b for b in word[i].encode("utf-8", "surrogatepass"))
            out.append((i + 1, sum(values[b] for b in at_bytes), at_bytes))
        return out


def read_vocabulary(path: str) -> Vocabulary:
    """The first distribution: scores are ranks of pieces, which get probabilities by Zipf's law."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ranks = [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and GAP not in piece[1:]:
            pieces.append(piece)
            ranks.append(max(0.0, -model.get_score(i)))
    ranks = np.array(ranks + [float(model.get_piece_size())] * 257)
    weights = 1.0 / (ranks + 3.0)
    return Vocabulary(pieces, np.log(weights / weights.sum()))


def _log_sum(values: list[float]) -> float:
    if len(values) == 1:
        return values[0]
    most = max(values)
    return most + math.log(sum([math.exp(v - most) for v in values])) if most > _NONE else most


def _alphas(word: str, vocabulary: Vocabulary) -> Iterator[float]:
    """Log probability of the beginnings of a word, from the empty one on. What is held is as wide as the longest piece."""
    ahead: deque[list[float]] = deque([[0.0]])
    for i in range(len(word)):
        here = _log_sum(ahead.popleft())
        yield here
        for j, log, _ in vocabulary.steps(word, i):
            while len(ahead) < j - i:
                ahead.append([])
            ahead[j - i - 1].append(here + log)
    yield _log_sum(ahead[0])


def forward(word: str, vocabulary: Vocabulary) -> float:
    """Log probability of a word over all its segmentations, however long it is."""
    return deque(_alphas(word, vocabulary), 1)[0]


def expected(word: str, weight: float, vocabulary: Vocabulary, counts: list[float]) -> None:
    """Adds how often each piece is expected in the word, by a forward and a backward recursion; a number a character is held."""
    alpha = array("d", _alphas(word, vocabulary))
    # Log probabilities of the ends of the word from the places behind, the nearest first.
    behind: deque[float] = deque([0.0], vocabulary.longest)
    for i in range(len(word) - 1, -1, -1):
        steps = vocabulary.steps(word, i)
        for j, log, pieces in steps:
            share = weight * math.exp(alpha[i] + log + behind[j - i - 1] - alpha[-1])
            for p in pieces:
                counts[p] += share
        behind.appendleft(_log_sum([log + behind[j - i - 1] for j, log, _ in steps]))


def words_of(text: str | None) -> list[bytes]:
    """Words between white space, A-Z in lower case, of one text; see ``split_words`` for many."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class _Batch:
    """Words of one length, and what the recursions over all of them at once need."""

    def __init__(self, words: list[str], vocabulary: Vocabulary) -> None:
        self.vocabulary, self.n = vocabulary, len(words[0])
        self.codes = code_points("".join(words)).reshape(len(words), self.n)
        powers = power("up", self.n + 1)
        sums = np.zeros((len(words), self.n + 1), np.uint64)
        np.cumsum((self.codes.astype(np.uint64) + np.uint64(1)) * powers[:-1], axis=1, out=sums[:, 1:])
        inverse = power("down", self.n + 1)
        values = vocabulary.logs
        self.steps: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for i in range(self.n):
            for j in range(i + 1, min(self.n, i + vocabulary.longest) + 1):
                hashes = mix((sums[:, j] - sums[:, i]) * inverse[i] + np.uint64(j - i))
                at = vocabulary.find(hashes)
                logs = np.where(at >= 0, values[at], _NONE)
                if j == i + 1 and (at < 0).any():
                    for code in np.unique(self.codes[at < 0, i]):
                        logs[(at < 0) & (self.codes[:, i] == code)] = sum(values[b] for b in self._bytes(code))
                if (logs > _NONE).any():
                    self.steps.append((i, j, at, logs))

    def _bytes(self, code: int) -> list[int]:
        return [len(self.vocabulary.pieces) + b for b in chr(code).encode("utf-8", "surrogatepass")]

    def forward(self) -> np.ndarray:
        alpha = np.full((self.n + 1, len(self.codes)), _NONE)
        alpha[0] = 0.0
        for i, j, _, logs in self.steps:
            np.logaddexp(alpha[j], alpha[i] + logs, out=alpha[j])
        return alpha

    def expected(self, weights: np.ndarray, counts: np.ndarray) -> None:
        alpha, beta = self.forward(), np.full((self.n + 1, len(self.codes)), _NONE)
        beta[self.n] = 0.0
        for i, j, _, logs in reversed(self.steps):
            np.logaddexp(beta[i], beta[j] + logs, out=beta[i])
        for i, j, at, logs in self.steps:
            share = weights * np.exp(alpha[i] + logs + beta[j] - alpha[self.n])
            known = at >= 0
            counts += np.bincount(at[known], share[known], minlength=len(counts))
            if j == i + 1 and not known.all():
                for code in np.unique(self.codes[~known, i]):
                    more = share[~known & (self.codes[:, i] == code)].sum()
                    for b in self._bytes(code):
                        counts[b] += more


# Words up to this length are evaluated many at a time, longer ones, which are rare, one by one.
_SHORT, _AT_ONCE = 40, 4096


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    """Positions of words of one length, the longer ones each alone."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        for i in range(0, len(part), _AT_ONCE if sizes[part[0]] <= _SHORT else 1):
            yield part[i:i + (_AT_ONCE if sizes[part[0]] <= _SHORT else 1)]


def forward_all(words: list[str], vocabulary: Vocabulary) -> np.ndarray:
    """``forward`` of every word."""
    out = np.zeros(len(words))
    for at in _by_length(words) if words else ():
        own = [words[k] for k in at]
        if vocabulary.crowded or len(own[0]) > _SHORT:
            out[at] = [forward(w, vocabulary) for w in own]
        else:
            out[at] = _Batch(own, vocabulary).forward()[-1]
    return out


def expected_all(words: list[str], weights: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The sum of ``expected`` over all words."""
    counts = np.zeros(len(vocabulary.logs))
    for at in _by_length(words) if words else ():
        own = [words[k] for k in at]
        if vocabulary.crowded or len(own[0]) > _SHORT:
            single = [0.0] * len(counts)
            for k, w in zip(at, own):
                expected(w, float(weights[k]), vocabulary, single)
            counts += single
        else:
            _Batch(own, vocabulary).expected(weights[at].astype(float), counts)
    return counts


def _gathered(batches: Iterator[pd.DataFrame], least: int = 50_000) -> Iterator[pd.DataFrame]:
    """Batches of at least so many words, as few words of one length cost nearly as much as many."""
    own: list[pd.DataFrame] = []
    for batch in batches:
        own.append(batch)
        if sum(map(len, own)) >= least:
            yield pd.concat(own, ignore_index=True)
            own = []
    if own:
        yield pd.concat(own, ignore_index=True)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, A-Z in lower case, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string()).fill_null("")))
    flat, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy()
    there = pc.binary_length(flat).to_numpy() > 0  # white space at an end leaves an empty string
    owners = np.repeat(np.arange(len(sizes)), sizes)[there]
    return flat.filter(pa.array(there)), np.bincount(owners, minlength=len(sizes))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts in training texts and in all, of about a million characters at a time; Spark
    adds them up before the shuffle."""
    for batch in batches:
        for learned in (True, False):
            texts = batch.column(0).filter(pc.equal(batch.column(1), learned))
            for some in chunks(texts):
                found = split_words(some)[0].value_counts()
                words, n = found.field(0), found.field(1).cast(pa.int64())
                train = n if learned else pa.array(np.zeros(len(words), np.int64))
                yield pa.RecordBatch.from_arrays([words, train, n], names=["word", "train", "n"])


@dataclass
class LanguageModel:
    """``words`` is a table of every word: ``word``, ``train`` (its count in training texts), ``n`` (in all
    texts), and log10 probabilities ``base`` and ``lattice``."""

    words: DataFrame
    tokens: int
    distinct: int
    base_end: float
    end: float
    texts: int


def train_lm(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", train: Column | None = None,
             settings: Settings = Settings()) -> LanguageModel:
    """Counts every word of ``docs``, learns from the rows where ``train`` holds, and scores all words.

    Null texts are empty, null conditions false.
    """
    s, spark = settings, docs.sparkSession
    use = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    rows = docs.select(F.col(text).alias("text"), use.alias("use"))
    counted = rows.mapInArrow(_counted, "word string, train long, n long")
    words = materialize(counted.groupBy("word").agg(F.sum("train").alias("train"), F.sum("n").alias("n")), "lm-words")
    texts = rows.filter("use").count()
    totals = words.agg(F.coalesce(F.sum("train"), F.lit(0)).alias("n"), F.count(F.when(F.col("train") > 0, 1)).alias("v")).first()
    tokens, distinct = totals["n"] + texts, totals["v"] + (texts > 0)

    for _ in range(s.rounds):
        shared = spark.sparkContext.broadcast((vocabulary.pieces, vocabulary.logs))

        def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = Vocabulary(*shared.value)
            counts = np.zeros(len(known.logs))
            for batch in _gathered(batches):
                counts += expected_all([GAP + w for w in batch["word"]], batch["train"].to_numpy(), known)
            found = np.flatnonzero(counts)
            yield pd.DataFrame({"piece": found, "n": counts[found]})

        # At most one row per piece and task, then per piece.
        sums = (words.filter("train > 0").select("word", "train").mapInPandas(expect, "piece long, n double")
                     .groupBy("piece").agg(F.sum("n").alias("n")).toPandas())
        counts = np.full(len(vocabulary.logs), s.smoothing)
        counts[sums["piece"]] += sums["n"]
        counts[-1] += texts
        vocabulary = Vocabulary(vocabulary.pieces, np.log(counts / counts.sum()))

    shared = spark.sparkContext.broadcast((vocabulary.pieces, vocabulary.logs))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Vocabulary(*shared.value)
        for batch in _gathered(batches):
            yield batch.assign(lattice=forward_all([GAP + w for w in batch["word"]], known) / math.log(10))

    base = F.log10((F.col("train") + 1) / F.lit(float(tokens + distinct + 1)))
    words = words.mapInPandas(scored, "word string, train long, n long, lattice double").withColumn("base", base)
    return LanguageModel(materialize(words, "lm-scores"), tokens, distinct, math.log10((texts + 1) / (tokens + distinct + 1)),
                         vocabulary.end / math.log(10), texts)


def _frequent(words: DataFrame, most: int) -> int:
    """The least power of two such that at most ``most`` words occur as often."""
    found = words.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count("*").alias("n")).collect()
    left, power_ = most, 63
    sizes = {r["power"]: r["n"] for r in found}
    while power_ >= 0 and sizes.get(power_, 0) <= left:
        left -= sizes.get(power_, 0)
        power_ -= 1
    return 2 ** (power_ + 1)


def score_documents(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """A row per row of ``docs``: key, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    The words of ``docs`` must be among those the model has counted. Null texts are empty: the end alone. Rows
    with equal or null keys are rows of their own; other columns are not looked at. An empty table gives none.
    """
    short = model.words.filter(F.length("word") <= settings.hot_length)
    is_hot = (F.col("n") >= _frequent(short, settings.hot)) & (F.length("word") <= settings.hot_length)
    hot = model.words.filter(is_hot).select("word", "train", "base", "lattice").toPandas()
    # One more entry, for words that are not among them.
    shared = docs.sparkSession.sparkContext.broadcast(
        (hot["word"].tolist(), *[np.append(hot[c].to_numpy(np.float64), 0.0) for c in ("train", "base", "lattice")]))
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("key", docs.schema[key].dataType),
                           *T.StructType.fromDDL("n long, known long, base double, lattice double, cold array<string>")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, train, base, lattice = shared.value
        index = {w: i for i, w in enumerate(words)}
        for batch in batches:
            start = 0
            for some in chunks(batch.column(2)):
                flat, sizes = split_words(some)
                encoded = flat.dictionary_encode()
                own = np.fromiter((index.get(w, -1) for w in encoded.dictionary.to_pylist()), np.int64, len(encoded.dictionary))
                at, owners = own[encoded.indices.to_numpy()], np.repeat(np.arange(len(sizes)), sizes)
                total = lambda values: np.bincount(owners, values[at], minlength=len(sizes)).astype(float)
                cold = np.bincount(owners[at < 0], minlength=len(sizes))
                offsets = np.concatenate(([0], np.cumsum(cold))).astype(np.int32)
                rest = pa.ListArray.from_arrays(pa.array(offsets), flat.filter(pa.array(at < 0)))
                numbers = [pa.array(sizes.astype(np.int64)), pa.array(total((train > 0).astype(float)).astype(np.int64)), pa.array(total(base)), pa.array(total(lattice))]
                keys = [batch.column(k).slice(start, len(some)) for k in (0, 1)]
                start += len(some)
                yield pa.RecordBatch.from_arrays([*keys, *numbers, rest], names=schema.names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    # Written, so that the row numbers are fixed before two branches use them.
    rows = materialize(rows.mapInArrow(read, schema), "lm-rows")
    cold = rows.select("row", F.explode("cold").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    cold = cold.join(model.words.filter(~is_hot), "word").groupBy("row").agg(
        F.sum(F.when(F.col("train") > 0, F.col("times")).otherwise(0)).alias("cold_known"),
        F.sum(F.col("times") * F.col("base")).alias("cold_base"), F.sum(F.col("times") * F.col("lattice")).alias("cold_lattice"))
    out = rows.drop("cold").join(cold, "row", "left")
    more = lambda name: F.coalesce(F.col(name), F.lit(0))
    return out.select(
        F.col("key").alias(key), (F.col("n") + 1).alias("n_tokens"), (F.col("known") + more("cold_known") + (1 if model.texts else 0)).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") + more("cold_base") + F.lit(model.base_end)).alias("base_score"),
        (F.col("lattice") + more("cold_lattice") + F.lit(model.end)).alias("score"))
