"""Chunks against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from brontide.operators import chunking as C
from brontide.session import materialize

PIECES = ["a", "bb", " ", "\n", "\n", "\r\n", "\x0b", "\x1c", "\x1f", "é", " ", "　",
          "\x85", "zzzzzzzz", "\t", "\r"]
EDGES = ["", "\n", "\n\n", " \n\t\n", "a", "a\n", "a b\r\n", "a\x0bb\x1cc\x85d e f\rg",
         "x" * 50 + "\n" + "y" * 3, " \n" * 12 + "end", "q\n" * 300]


def texts() -> list[str]:
    rnd = random.Random(7)
    return EDGES + ["".join(rnd.choices(PIECES, k=rnd.randint(0, 400))) for _ in range(200)]


def brute_force(text: str, max_lines: int, max_chars: int) -> list[tuple]:
    lines, chunks, at, offset = text.splitlines(), [], 0, 0
    while at < len(lines):
        end = at + 1
        while (end < len(lines) and end - at < max_lines
               and len("\n".join(lines[at:end + 1])) < max_chars):
            end += 1
        size = sum(len(line) + 1 for line in lines[at:end])
        message = "\n".join(lines[at:end]).strip()
        if message:
            chunks.append((len(chunks), at + 1, end, offset, offset + size, message))
        at, offset = end, offset + size
    return chunks


def by_id(df) -> dict:
    found = {}
    for row in df.collect():
        found.setdefault(row["id"], []).append(tuple(row)[1:])
    return {k: sorted(v) for k, v in found.items()}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(texts())), "id int, text string")


@pytest.fixture(scope="module")
def lines(docs):
    return materialize(C.split_lines(docs), "test-lines")


def test_split_lines(docs):
    found = by_id(C.split_lines(docs))
    for i, text in enumerate(texts()):
        assert found.get(i, []) == list(enumerate(text.splitlines(), start=1))


@pytest.mark.parametrize("limits", [(5, 30), (3, 8), (80, 8000), (1, 1), (7, 60)])
def test_chunk_text(docs, limits):
    found = by_id(C.chunk_text(docs, "text", *limits))
    for i, text in enumerate(texts()):
        assert found.get(i, []) == brute_force(text, *limits)


@pytest.mark.parametrize("limits", [(5, 30, 8, 2), (3, 8, 5, 3), (4, 40, 4, 2), (7, 1000, 16, 4),
                                    (80, 8000, 1024, 1024), (80, 90, 90, 2)])
def test_chunk_lines(lines, limits):
    """Blocks of a few lines and a tree of several levels."""
    found = by_id(C.chunk_lines(lines, ["id"], *limits))
    for i, text in enumerate(texts()):
        assert found.get(i, []) == brute_force(text, *limits[:2])


def test_chunk_text_of_many_chunks(spark):
    """More chunks than the open list of the fold holds, several times over."""
    text = "\n".join(str(i) for i in range(3000))
    df = spark.createDataFrame([(0, text)], "id int, text string")
    assert by_id(C.chunk_text(df, "text", 2, 8000))[0] == brute_force(text, 2, 8000)


def test_null_text_has_no_chunks(spark):
    df = spark.createDataFrame([(0, None)], "id int, text string")
    assert C.chunk_text(df).count() == 0 and C.split_lines(df).count() == 0


def test_number_lines_with_a_dominant_and_a_null_key(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 30 > 0, F.col("id").cast("string"))
         .alias("k"), (20_000 - F.col("id")).alias("o"))
    rows = C.number_lines(df, ["k"], ["o"]).collect()
    assert len(rows) == 20_000
    groups = {}
    for row in rows:
        groups.setdefault(row["k"], []).append((row["o"], row["line_no"]))
    assert len(groups["hot"]) > 10_000 and None in groups
    for group in groups.values():
        assert [n for _, n in sorted(group)] == list(range(1, len(group) + 1))


def test_one_long_log_spreads_over_tasks(spark):
    """A log that is nearly all of the data is chunked in many independent groups."""
    df = spark.range(60_000).select(
        F.when(F.col("id") < 59_000, "big").otherwise(F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") < 59_000, F.col("id") + 1).otherwise(1).alias("line_no"),
        F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("line"))
    chunks = C.chunk_lines(materialize(df, "long"), ["id"], 80, 1500)
    text = "\n".join("x" * (i % 90) for i in range(59_000))
    found = by_id(chunks)
    assert found["big"] == brute_force(text, 80, 1500)
    # The other logs have one line each; an empty one has no chunk.
    assert set(found) == {"big"} | {str(i) for i in range(59_000, 60_000) if i % 90}
