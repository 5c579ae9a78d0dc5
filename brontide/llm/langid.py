"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Letters are lower-cased, every run of anything else becomes one blank, and n-grams of one to three
characters are hashed into a fixed number of features. Document frequencies are counted over all
training rows on the executors. The weights are learned by follow-the-regularised-leader with L1 and
L2 penalties on a sample with a documented bound, and the softmax is calibrated by a temperature on the
part of the sample that the weights have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from brontide.llm.common import code_points, replace_columns, texts_of, uniform

UNKNOWN = "und"
_BITS = 16
FEATURES = 1 << _BITS
_letters: list[np.ndarray] = []


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the rows that the weights are fitted on (expected number, shared evenly by
    the languages), ``languages`` the different labels; a sampled row has at most ``FEATURES`` values."""

    sample: int = 6000
    languages: int = 1000
    epochs: int = 3
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.002
    calibration: float = 0.2
    seed: int = 8


@dataclass
class LanguageModel:
    """``weights`` has a row per feature and one for the intercept, a column per language."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0
    report: dict = field(default_factory=dict)


def _letter_table() -> np.ndarray:
    """Per code point the lower-case letter, or a blank for what is no letter."""
    if not _letters:
        _letters.append(np.array([ord(chr(i).lower()[0]) if chr(i).isalpha() else 32
                                  for i in range(0x110000)], np.uint32))
    return _letters[0]


def letters(text: str | None) -> np.ndarray:
    """Lower-case letters with one blank for each run of anything else, also at both ends."""
    out = np.concatenate((np.full(1, 32, np.uint32), _letter_table()[code_points(text)],
                          np.full(1, 32, np.uint32)))
    blank = out == 32
    return out[~(blank & np.concatenate(([False], blank[:-1])))]


def gram_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and how often each occurs."""
    shift = np.uint32(32 - _BITS)
    one = codes * np.uint32(0x9E3779B1)
    two = (one[:-1] + codes[1:]) * np.uint32(0x85EBCA6B)
    three = (two[:-1] + codes[2:]) * np.uint32(0xC2B2AE35)
    counts = np.bincount(np.concatenate((one, two, three)) >> shift, minlength=FEATURES)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _vector(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = np.log1p(counts) * idf[found]
    return values / (np.sqrt(values @ values) or 1.0)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals, n = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for text in texts_of(batch.column(0)):
            totals[gram_counts(letters(text))[0]] += 1
        n += len(batch)
    found = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(found, -1)), pa.array(np.append(totals[found], n))], names=["feature", "n"])


def _sample_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        grams = [gram_counts(letters(text)) for text in batch["text"]]
        yield pd.DataFrame({"label": batch["label"], "order": batch["order"],
                            "found": [g[0].astype(np.int32) for g in grams],
                            "counts": [g[1].astype(np.int32) for g in grams]})


def _ftrl(rows: list[int], labels: np.ndarray, row, n_classes: int, s: Settings) -> np.ndarray:
    """Weights of the rows, one pass over them per epoch; ``row`` gives the features and values of one."""
    z = np.zeros((FEATURES + 1, n_classes), np.float64)
    n = np.zeros_like(z)

    def weights(at):
        zs, root = z[at], np.sqrt(n[at])
        return np.where(np.abs(zs) <= s.l1, 0.0,
                        -(zs - np.sign(zs) * s.l1) / ((s.beta + root) / s.alpha + s.l2))

    for _ in range(s.epochs):
        for r in rows:
            found, values = row(r)
            w = weights(found)
            error = _softmax(values @ w)
            error[labels[r]] -= 1.0
            g = np.outer(values, error)
            old = n[found]
            n[found] = old + g * g
            z[found] += g - (np.sqrt(n[found]) - np.sqrt(old)) / s.alpha * w
    return weights(slice(None))


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by a search over a fine grid.

    The labels are smoothed by one row's worth of doubt: without it, rows that are all predicted
    rightly would drive the temperature to zero.
    """
    n, k = logits.shape
    if not n or k < 2:
        return 1.0
    target = np.full((n, k), 1.0 / (n + 2) / (k - 1))
    target[np.arange(n), labels] = 1 - 1.0 / (n + 2)
    grid = np.geomspace(0.02, 20.0, 121)
    losses = [-(target * np.log(np.maximum(_softmax(logits / t), 1e-300))).sum(axis=1).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def train_language_id(rows: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id",
                      train: Column | None = None, settings: Settings = Settings()) -> LanguageModel:
    """Learns from the rows where ``train`` holds and neither text nor label is null.

    Without such rows the model knows no language, and answers ``und`` everywhere. More labels than
    ``settings.languages`` are an error. Weights are learned from ``settings.sample`` rows by expectation and twice as many at
    most, shared evenly by the languages; equal rows are rows of their own. Re-runs on the same files agree.
    """
    spark = rows.sparkSession
    use = F.col(text).isNotNull() & F.col(label).isNotNull()
    rows = rows.filter(use if train is None else use & train)
    rows = rows.select(F.col(text).alias("text"), F.col(label).cast("string").alias("label"),
                       # By row, so that of many equal rows a share is drawn, and not all or none.
                       uniform(F.col(key), F.col(text), F.monotonically_increasing_id(), seed=settings.seed).alias("order"))
    counts = rows.groupBy("label").agg(F.count("*").alias("n")).limit(settings.languages + 1).collect()
    if len(counts) > settings.languages:
        raise ValueError(f"more than {settings.languages} languages")
    sizes = {r["label"]: r["n"] for r in counts}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros(FEATURES), np.zeros((FEATURES + 1, 0)))
    counted = (rows.select("text").mapInArrow(_document_frequencies, "feature long, n long")
                   .groupBy("feature").agg(F.sum("n").alias("n")).toPandas())
    total = int(counted.loc[counted["feature"] == -1, "n"].sum())
    counted = counted[counted["feature"] >= 0]
    idf = np.full(FEATURES, np.log(1 + total))
    idf[counted["feature"]] -= np.log(1 + counted["n"])
    idf += 1.0
    share = settings.sample / len(languages)
    rates = spark.createDataFrame([(k, min(1.0, share / sizes[k])) for k in languages], "label string, rate double")
    picked = (rows.join(F.broadcast(rates), "label").filter(F.col("order") < F.col("rate"))
                  .mapInPandas(_sample_features, "label string, order double, found array<int>, counts array<int>"))
    # The rows drawn are about ``share`` of each language, and never more than twice as many.
    first = F.row_number().over(Window.partitionBy("label").orderBy("order"))
    picked = picked.withColumn("rank", first).filter(F.col("rank") <= max(1, int(2 * share))).drop("rank").toArrow().combine_chunks()
    # In the order of another hash, so that languages alternate whatever their rates are.
    order = picked.column("order").to_numpy()
    names = np.array(picked.column("label").to_pylist(), dtype=object)
    rank = np.lexsort((order, np.modf(order * 1048573.0)[0])) if len(order) else np.zeros(0, int)
    ids = {k: i for i, k in enumerate(languages)}
    labels = np.array([ids[k] for k in names], int)
    # All rows in one array each, as the sample is the most that the driver holds.
    features, starts = _flat(picked.column("found"))
    values = (np.log1p(_flat(picked.column("counts"))[0]) * idf[features]).astype(np.float32)
    del picked

    def row(r: int) -> tuple[np.ndarray, np.ndarray]:
        own = values[starts[r]:starts[r + 1]].astype(np.float64)
        return (np.append(features[starts[r]:starts[r + 1]], FEATURES), np.append(own / (np.sqrt(own @ own) or 1.0), 1.0))

    cut = int(len(rank) * (1 - settings.calibration))
    weights = _ftrl(list(rank[:cut] if cut else rank), labels, row, len(languages), settings)
    rest = rank[cut:]
    logits = np.array([v @ weights[f] for f, v in map(row, rest)]).reshape(len(rest), len(languages))
    report = {"rows": len(rank), "non_zero": int(np.count_nonzero(weights)),
              "calibration_accuracy": float((logits.argmax(1) == labels[rest]).mean()) if len(rest) else None}
    return LanguageModel(languages, idf.astype(np.float32), weights.astype(np.float32),
                         _temperature(logits, labels[rest]), report)


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of lists, and where each list starts and the last one ends."""
    sizes = pc.list_value_length(lists).to_numpy()
    return pc.list_flatten(lists).to_numpy(), np.concatenate(([0], np.cumsum(sizes)))


def identify_language(rows: DataFrame, model: LanguageModel, text: str = "text",
                      into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``rows`` with the predicted language and its calibrated probability.

    A null text, one without a letter, and any text if the model knows no language: ``und`` with 0.
    Of equally likely languages the first by name wins. Columns named like the new ones are replaced.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<language:string,probability:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in batches:
            languages, probabilities = [], []
            for value in texts_of(batch):
                codes = letters(value)
                if len(codes) < 2 or not m.languages:
                    languages.append(UNKNOWN)
                    probabilities.append(0.0)
                    continue
                found, counts = gram_counts(codes)
                logits = _vector(found, counts, m.idf) @ m.weights[found] + m.weights[FEATURES]
                p = _softmax(logits.astype(np.float64) / m.temperature)
                languages.append(m.languages[int(p.argmax())])
                probabilities.append(float(p.max()))
            yield pa.StructArray.from_arrays([pa.array(languages, pa.string()), pa.array(probabilities, pa.float64())],
                                             names=["language", "probability"])

    guess = rows.withColumn("__guess", predict(F.col(text)))
    return replace_columns(guess, {into[0]: F.col("__guess.language"),
                                   into[1]: F.col("__guess.probability")}).drop("__guess")
