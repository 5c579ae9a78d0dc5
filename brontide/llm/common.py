"""Helpers of the operators: folds, table reads and hashing of text in NumPy."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The white space that separates words, and the pattern of a word.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, n: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves this remainder; false for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % n == remainder, F.lit(False))


def uniform(*cols, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the values only, so that re-runs agree."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """``df`` with the new columns; those it had under the same names, in any case, give way."""
    names = {c.lower() for c in new}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in names],
                     *[c.alias(n) for n, c in new.items()])


def chunks(texts: pa.Array, most: int = 8_000_000) -> Iterator[pa.Array]:
    """Runs of texts of about so many bytes; a null counts as none."""
    sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + most)) + 1
        yield texts.slice(start, stop - start)
        start = stop
    give_back()


def give_back() -> None:
    """Returns memory that is free within this process to the system. Python workers live on after their
    task, and several of them share an executor; what they only keep for later would be missing elsewhere."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def texts_of(texts: pa.Array, most: int = 2_000_000) -> Iterator[str | None]:
    """The texts as Python strings, of which only a few are held at a time."""
    for some in chunks(texts, most):
        yield from some.to_pylist()


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def is_space(codes: np.ndarray) -> np.ndarray:
    return (codes == 32) | ((codes >= 9) & (codes <= 13))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def power(name: str, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        factors = np.full(2 * n, _BASE if name == "up" else _INVERSE)
        factors[0] = 1
        _powers[name] = np.cumprod(factors)
    return _powers[name][:n]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans of a text, by differences of one polynomial prefix sum."""
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power("up", len(codes)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * power("down", len(codes) + 1)[starts]
               + (ends - starts).astype(np.uint64))


def word_hashes(codes: np.ndarray) -> np.ndarray:
    return span_hashes(codes, *runs(~is_space(codes)))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the windows of n consecutive values; order matters."""
    if len(hashes) < n:
        return hashes[:0]
    out = hashes[: len(hashes) - n + 1].copy()
    for i in range(1, n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[i: len(hashes) - n + 1 + i]
    return mix(out)
