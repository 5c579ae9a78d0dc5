"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a sparse row x is ``sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)``. The pairs are
never enumerated: ``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i (v_if x_i)^2]``
is linear in the number of values. The machine is fitted on a sample of labelled rows with a hard bound.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from brontide.llm.common import code_points, is_space, replace_columns, runs, span_hashes, texts_of, uniform, windows
from brontide.session import materialize

_BITS = 16
WORDS = 1 << _BITS
# Characters that clean prose has few of.
SYMBOLS = "#*$%&|<>"
STATISTICS = ("symbols", "bars", "shouts", "capitals", "shouted words", "digits", "letters", "word length",
              "distinct words", "commonest word", "stutter", "repeated lines", "repeated windows",
              "sentence ends", "line length", "words", "empty")


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled rows that the machine is fitted on."""

    sample: int = 8000
    rank: int = 6
    epochs: int = 6
    rate: float = 0.15
    l2: float = 1e-4
    seed: int = 5


@dataclass
class QualityModel:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    metadata: tuple[str, ...]
    report: dict = field(default_factory=dict)


def _share(part, whole) -> float:
    return float(part) / whole if whole else 0.0


def statistics(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The values named in ``STATISTICS``, all of the order of one, from one text."""
    n, w = len(codes), len(hashes)
    if not w:
        return np.append(np.zeros(len(STATISTICS) - 1), 1.0)
    symbols = np.isin(codes, [ord(c) for c in SYMBOLS])
    small = codes < 128
    upper = (small & (codes >= 65) & (codes <= 90)) | ((codes >= 0xC0) & (codes <= 0xDE) & (codes != 0xD7))
    lower = ((small & (codes >= 97) & (codes <= 122)) | (codes >= 0xDF)) & (codes != 0xF7)
    counts = np.concatenate(([0], np.cumsum(upper)))
    lowers = np.concatenate(([0], np.cumsum(lower)))
    uppers = counts[ends] - counts[starts]
    shouted = (uppers >= 2) & (lowers[ends] == lowers[starts])
    n_letters = int(upper.sum() + lower.sum())
    _, repeats = np.unique(hashes, return_counts=True)
    ls, le = runs(codes != 10)
    spaces = np.concatenate(([0], np.cumsum(is_space(codes))))
    wordy = spaces[le] - spaces[ls] < le - ls
    lines = span_hashes(codes, ls[wordy], le[wordy])
    triples = windows(hashes, 3)
    last = codes[ends - 1]
    return np.array([
        min(3.0, _share(symbols.sum(), w)), min(3.0, _share((codes == 124).sum(), w) * 2),
        min(3.0, _share((codes == 33).sum(), w)), _share(upper.sum(), n_letters), _share(shouted.sum(), w),
        _share((small & (codes >= 48) & (codes <= 57)).sum(), n), _share(n_letters, n),
        min(3.0, float((ends - starts).mean()) / 10), _share(len(repeats), w), _share(repeats.max(), w),
        _share((hashes[1:] == hashes[:-1]).sum(), w), _share(len(lines) - len(np.unique(lines)), len(lines)),
        _share(len(triples) - len(np.unique(triples)), len(triples)),
        min(1.0, _share(np.isin(last, (46, 63, 33)).sum(), w) * 4), min(3.0, _share(w, len(lines)) / 50),
        min(3.0, np.log1p(w) / 5), 0.0])


def vector(text: str | None, metadata: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    """Features and values: words by hash, weighted to length one, then statistics and metadata."""
    codes = code_points(text)
    starts, ends = runs(~is_space(codes))
    hashes = span_hashes(codes, starts, ends)
    words, counts = np.unique(hashes >> np.uint64(64 - _BITS), return_counts=True)
    values = np.log1p(counts)
    values = values / (np.sqrt(values @ values) or 1.0)
    known = np.asarray(metadata, np.float64)
    there = np.isfinite(known)
    size = np.where(there, np.log1p(np.maximum(np.where(there, known, 0.0), 0.0)) / 10, 0.0)
    rest = np.concatenate((statistics(codes, starts, ends, hashes), size, ~there))
    found = np.concatenate((words.astype(np.int64), WORDS + np.arange(len(rest))))
    return found, np.concatenate((values, rest))


def score(bias: float, linear: np.ndarray, factors: np.ndarray, found: np.ndarray, values: np.ndarray) -> float:
    """Logit of one row in linear time."""
    parts = factors[found] * values[:, None]
    sums = parts.sum(axis=0)
    return float(bias + linear[found] @ values + 0.5 * (sums @ sums - (parts * parts).sum()))


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-min(max(x, -40.0), 40.0)))


def _fit(labels: np.ndarray, row, size: int, s: Settings) -> tuple[float, np.ndarray, np.ndarray]:
    """AdaGrad on the log loss; ``row`` gives the features and values of a row."""
    random = np.random.default_rng(s.seed)
    positive = np.mean(labels)
    bias = float(np.log((positive + 0.01) / (1.01 - positive)))
    linear, factors = np.zeros(size), random.normal(0, 0.05, (size, s.rank))
    seen_linear, seen_factors, seen_bias = np.full(size, 1e-2), np.full((size, s.rank), 1e-2), 1e-2
    for _ in range(s.epochs):
        for i in random.permutation(len(labels)):
            y, (found, values) = labels[i], row(i)
            v = factors[found]
            parts = v * values[:, None]
            sums = parts.sum(axis=0)
            logit = bias + linear[found] @ values + 0.5 * (sums @ sums - (parts * parts).sum())
            g = _sigmoid(logit) - y
            seen_bias += g * g
            bias -= s.rate * g / np.sqrt(seen_bias)
            gl = g * values + s.l2 * linear[found]
            seen_linear[found] += gl * gl
            linear[found] -= s.rate * gl / np.sqrt(seen_linear[found])
            gv = g * values[:, None] * (sums - parts) + s.l2 * v
            seen_factors[found] += gv * gv
            factors[found] = v - 0.3 * s.rate * gv / np.sqrt(seen_factors[found])
    return bias, linear, factors


def _metadata(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).cast("array<double>")


def train_quality(rows: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
                  label: str = "quality", metadata: Sequence[str] = (), train: Column | None = None,
                  settings: Settings = Settings()) -> QualityModel:
    """Learns from the labelled rows where ``train``, a condition on the key, holds.

    A key with several labels counts with the least one; null keys and labels other than 0 and 1
    count not at all. A key with several rows counts with one of them, that with the least hash of its text and
    metadata, so that no more than ``settings.sample`` rows come to the driver. Without labelled rows every score is one half.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).alias("label"), *([] if train is None else [train.alias("use")]))
    known = known.filter("key is not null and label in (0, 1)" + (" and use" if train is not None else ""))
    known = known.groupBy("key").agg(F.min("label").cast("int").alias("label"))
    total = known.count()
    # The bound is hard, so the broadcast is of at most `sample` pairs.
    order = uniform(F.col("key"), seed=settings.seed)
    picked = known.filter(order < 1.1 * settings.sample / max(1, total)).orderBy(order, "key").limit(settings.sample)
    picked = materialize(picked, "picked-labels")
    chosen = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), _metadata(metadata).alias("meta"))
    hashed = chosen.withColumn("hash", F.xxhash64("text", "meta"))
    least = hashed.join(F.broadcast(picked), "key").groupBy("key", "label").agg(F.min("hash").alias("hash"))
    least = materialize(least, "picked-rows")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set = set()
        for batch in batches:
            # Copies are left out before their features are computed.
            batch = batch[~batch["key"].duplicated() & ~batch["key"].isin(seen)]
            seen.update(batch["key"])
            found = [vector(t, np.asarray(m, np.float64)) for t, m in zip(batch["text"], batch["meta"])]
            yield pd.DataFrame({"key": batch["key"].astype(str), "label": batch["label"],
                                "found": [f.astype(np.int32) for f, _ in found],
                                "values": [v.astype(np.float32) for _, v in found]})

    # One row per key and task, then one per key.
    found = (hashed.join(F.broadcast(least), ["key", "hash"]).drop("hash")
                   .mapInPandas(features, "key string, label int, found array<int>, values array<float>")
                   .dropDuplicates(["key"]).toArrow().combine_chunks())
    size = WORDS + len(STATISTICS) + 2 * len(metadata)
    if not len(found):
        return QualityModel(0.0, np.zeros(size, np.float32), np.zeros((size, settings.rank), np.float32), tuple(metadata))
    # All rows in one array each, as the sample is the most that the driver holds.
    starts = np.concatenate(([0], np.cumsum(pc.list_value_length(found.column("found")).to_numpy())))
    at, values = (pc.list_flatten(found.column(c)).to_numpy() for c in ("found", "values"))
    check = np.add.reduceat(values, starts[:-1])
    order = np.lexsort((check, np.array(found.column("key").to_pylist())))
    labels_ = found.column("label").to_numpy()[order]
    del found

    def row(i: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(starts[order[i]], starts[order[i] + 1])
        return at[own], values[own].astype(np.float64)

    bias, linear, factors = _fit(labels_, row, size, settings)
    return QualityModel(bias, linear.astype(np.float32), factors.astype(np.float32), tuple(metadata), {"rows": len(labels_)})


def score_quality(rows: DataFrame, model: QualityModel, text: str = "text", threshold: float = 0.3,
                  into: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``rows`` with a score from 0 to 1 and whether it reaches the threshold, as 1 or 0.

    Null and empty texts are scored from their statistics and metadata; null metadata is a feature
    of its own. Columns named like the new ones are replaced.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        m = shared.value
        for texts, metas in batches:
            known = (np.asarray(x, np.float64) for x in metas.to_pylist())
            yield pa.array([_sigmoid(score(m.bias, m.linear, m.factors, *vector(t, x))) for t, x in zip(texts_of(texts), known)], pa.float64())

    scored = rows.withColumn("__score", scores(F.col(text), _metadata(model.metadata)))
    return replace_columns(scored, {into[0]: F.col("__score"),
                                    into[1]: (F.col("__score") >= threshold).cast("int")}).drop("__score")
