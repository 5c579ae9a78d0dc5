import hashlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from brontide.functions import text as X
from brontide.operators import logs as L

EDGES = ["", "\n", "\n\n", "a", "a\n", "a\r\n", "a\rb", "a\x0bb\x0cc", "x\x85y z ", "é\x1c\x1d\x1e"]
words = st.sampled_from(["ERR", "OR", "error", "Warn", "ing", "info", "DEBUG", " ", "\n", "\r", "ß", "\x1c",
                         "Out of memory", "time", "out", "Permission denied", " ", "exception", "x"])


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, content string")


def test_fingerprint(spark):
    for row in L.fingerprint_text(frame(spark, EDGES)).collect():
        text = row["content"]
        assert row["content_hash"] == hashlib.sha256(text.encode()).hexdigest()
        assert row["content_size_bytes"] == len(text.encode())
        assert row["line_count"] == len(text.splitlines()), repr(text)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(words, max_size=8).map("".join), min_size=200, max_size=200))
def test_text_functions_follow_python(spark, values):
    df = frame(spark, values).select(
        "content", X.strip(F.col("content")).alias("strip"), X.lines(F.col("content")).alias("lines"),
        X.guess_level(F.col("content")).alias("level"), X.is_error(F.col("content")).alias("error"))
    for row in df.collect():
        text, upper = row["content"], row["content"].upper()
        assert row["strip"] == text.strip()
        assert row["lines"] == text.splitlines()
        levels = [level for level in X.LEVELS if level in upper]
        assert row["level"] == (levels[0] if levels else None)
        assert row["error"] == any(token in upper for token in X.ERROR_TOKENS)


def test_null_message(spark):
    df = spark.createDataFrame([(None,)], "m string")
    row = df.select(X.guess_level(F.col("m")), X.is_error(F.col("m"))).first()
    assert tuple(row) == (None, False)
