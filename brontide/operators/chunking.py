"""Splitting of log texts into chunks of whole lines.

A chunk takes lines until it has ``max_lines`` of them or the next line would bring its joined
length to ``max_chars``; a longer single line stays whole. A chunk's message is its stripped
text, and chunks without one are dropped before numbering. Character offsets count every line
terminator as one character.

Two forms give the same chunks:

* ``chunk_text`` for texts held in a cell. One pass per text, no shuffle.
* ``chunk_lines`` for logs held as rows of lines, of any length. A single log may be most of
  the data, so it is cut into blocks that are chunked independently of each other.

Where a chunk ends depends on where it began, hence on all lines before. ``chunk_lines`` breaks
this chain as follows. A chunk has at most ``max_lines`` lines, so the first chunk that begins
in a block begins in one of its first ``max_lines`` lines. For each of these possible entries the
block alone (and the lengths of the lines just behind it) tells the entry into the next block.
These small tables compose, so the true entries follow from composing them in a tree over the
blocks, and then every block can be chunked by itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from brontide.functions import text as X
from brontide.operators.project import column
from brontide.session import materialize

MAX_LINES = 80
MAX_CHARS = 8_000

# Spans are appended to a short open list, and full lists to a list of lists: appending copies
# a list, which for a text of many chunks would otherwise take quadratic time.
_OPEN_SPANS = 512
_SPANS = "array<struct<first: int, n: int, start: bigint, chars: bigint>>"

_BLOCK_LINES = 1_024
_FAN_OUT = 1_024
# Places at which the blocks that are composed in one row can be entered, all together: about a megabyte.
_ROW_PLACES = 81_920


def _spans(lengths: Column, max_lines: int, max_chars: int) -> Column:
    """Chunks over an array of line lengths: first line (from 0), lines, start, characters."""
    fields = ("done", "open", "first", "n", "start", "chars")

    def state(*values: Column) -> Column:
        return F.struct(*[v.alias(f) for v, f in zip(values, fields)])

    def close(acc: Column) -> tuple[Column, Column]:
        span = F.struct(acc["first"].alias("first"), acc["n"].alias("n"),
                        acc["start"].alias("start"), acc["chars"].alias("chars"))
        full = F.size(acc["open"]) >= _OPEN_SPANS
        return (F.when(full, F.array_append(acc["done"], acc["open"])).otherwise(acc["done"]),
                F.when(full, F.array(span)).otherwise(F.array_append(acc["open"], span)))

    def add(acc: Column, length: Column) -> Column:
        # ``chars`` counts a terminator per line, so the joined length with this line added is
        # chars + length.
        full = (acc["n"] >= max_lines) | (acc["chars"] + length >= max_chars)
        begun = state(*close(acc), acc["first"] + acc["n"], F.lit(1),
                      acc["start"] + acc["chars"], length + 1)
        extended = state(acc["done"], acc["open"], acc["first"], acc["n"] + 1,
                         acc["start"], acc["chars"] + length + 1)
        return F.when((acc["n"] > 0) & full, begun).otherwise(extended)

    def finish(acc: Column) -> Column:
        done, opened = close(acc)
        return (F.when(acc["n"] > 0, F.concat(F.flatten(done), opened))
                 .otherwise(F.array().cast(_SPANS)))

    zero = F.lit(0).cast("bigint")
    nothing = state(F.array().cast(f"array<{_SPANS}>"), F.array().cast(_SPANS),
                    F.lit(0), F.lit(0), zero, zero)
    return F.aggregate(lengths, nothing, add, finish)


def _messages(lines: Column, spans: Column) -> Column:
    """The spans with their messages, without those that have none."""
    def chunk(span: Column) -> Column:
        joined = F.array_join(F.slice(lines, span["first"] + 1, span["n"]), "\n")
        return F.struct(span["first"].alias("first"), span["n"].alias("n"),
                        span["start"].alias("start"), span["chars"].alias("chars"),
                        X.strip(joined).alias("message"))

    return F.filter(F.transform(spans, chunk), lambda c: c["message"] != "")


def _explode_chunks(df: DataFrame, keep: list[str], index=0, line=0, char=0) -> DataFrame:
    """One row per element of ``_chunks``; the last arguments are the offsets of the first."""
    # The outer form: for the plain one the optimizer would add a filter on non-empty arrays, and
    # compute the array in it a second time.
    rows = (df.select("*", F.posexplode_outer("_chunks").alias("_pos", "_c"))
              .filter(F.col("_pos").isNotNull()))
    numbers = {
        "chunk_index": F.col("_pos") + index,
        "line_start": F.col("_c.first") + 1 + line,
        "line_end": F.col("_c.first") + F.col("_c.n") + line,
        "char_start": F.col("_c.start") + char,
        "char_end": F.col("_c.start") + F.col("_c.chars") + char,
    }
    return rows.select(*[column(k) for k in keep],
                       *[value.cast("bigint").alias(name) for name, value in numbers.items()],
                       F.col("_c.message").alias("message"))


def split_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per line, numbered from 1, in place of the text."""
    kept = [column(c) for c in df.columns if c != text]
    rows = (df.select(*kept, F.posexplode_outer(X.lines(column(text))).alias("_pos", "line"))
              .filter(F.col("_pos").isNotNull()))
    return rows.select(*kept, (F.col("_pos") + 1).cast("bigint").alias("line_no"), "line")


def chunk_text(df: DataFrame, text: str = "text", max_lines: int = MAX_LINES,
               max_chars: int = MAX_CHARS) -> DataFrame:
    """The chunks of every text, next to the other columns; a NULL or empty text has none."""
    kept = [c for c in df.columns if c != text]
    lines = df.select(*[column(c) for c in kept], X.lines(column(text)).alias("_lines"))
    spans = lines.withColumn(
        "_spans", _spans(F.transform("_lines", F.length), max_lines, max_chars))
    return _explode_chunks(
        spans.withColumn("_chunks", _messages(F.col("_lines"), F.col("_spans"))), kept)


# --- logs of any length ---------------------------------------------------------------------

def number_lines(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Add ``line_no``, counting from 1 within ``keys`` in the order of ``order_by``.

    ``keys`` and ``order_by`` together must identify a row. Rows are sorted by range, so that
    the rows of one key spread over as many tasks as their number calls for; a key's rows in
    different tasks are put in sequence from their counts alone.
    """
    order = [*keys, *order_by]
    ranged = (df.repartitionByRange(*[column(c) for c in order])
                .sortWithinPartitions(*[column(c) for c in order])
                .select("*", F.spark_partition_id().alias("_part"),
                        F.monotonically_increasing_id().alias("_id")))
    return number_in_sequence(materialize(ranged, "lines"), keys, ["_part"]).drop("_part")


def number_in_sequence(df: DataFrame, keys: list[str], segment: list[str]) -> DataFrame:
    """Replace ``_id`` by ``line_no``, given that ``_id`` rises by one from row to row within a
    segment of a key and that segments follow each other in the order of ``segment``."""
    whole = [*keys, *segment]
    counts = df.groupBy(*[column(c) for c in whole]).agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # A struct equals another one field by field with NULLs equal.
    shifts = (segment_shifts(counts, keys, segment)
              .select(F.struct(*[column(c) for c in whole]).alias("_segment"), "_shift"))
    return (df.withColumn("_segment", F.struct(*[column(c) for c in whole]))
              .join(materialize(shifts, "shifts"), "_segment")
              .withColumn("line_no", F.col("_id") + F.col("_shift"))
              .drop("_segment", "_shift", "_id"))


def segment_shifts(counts: DataFrame, keys: list[str], segment: list[str]) -> DataFrame:
    """Add to rows ``keys, segment, _first, _n`` what turns an ``_id`` into a line number.

    The running sum over a key has one row per segment, not per line. Stored, the result has a
    known size, by which Spark decides whether to broadcast it.
    """
    before = (Window.partitionBy(*[column(c) for c in keys])
                    .orderBy(*[column(c) for c in segment])
                    .rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn(
        "_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1)


def chunk_lines(df: DataFrame, keys: list[str], max_lines: int = MAX_LINES,
                max_chars: int = MAX_CHARS, block_lines: int = _BLOCK_LINES,
                fan_out: int = _FAN_OUT) -> DataFrame:
    """The chunks of every log in rows ``keys, line_no, line``.

    ``line_no`` counts from 1 without gaps within ``keys``. The input is read two or three times,
    once for its line numbers only, so it should be a stored table.
    """
    max_lines = max(max_lines, 1)
    block_lines = max(block_lines, max_lines)
    fan_out = max(2, min(fan_out, _ROW_PLACES // max_lines))
    rows = df.select(F.struct(*[column(k) for k in keys]).alias("_key"),
                     (F.col("line_no") - 1).alias("_at"), "line")
    # Logs of several blocks: few, as each has at least a block of lines. Stored, their size
    # decides on a broadcast.
    lasts = rows.groupBy("_key").agg(F.max("_at").alias("_last"))
    long_logs = materialize(lasts.filter(F.col("_last") >= block_lines), "long-logs")
    last = long_logs.agg(F.max("_last")).first()[0]

    blocks = _blocks(rows, block_lines, max_lines, F.col("line"))
    zero = F.lit(0).cast("bigint")
    if last is None:
        entered = blocks.select("*", F.lit(0).alias("_entry"), zero.alias("_index"),
                                zero.alias("_chars"))
    else:
        measured = rows.join(long_logs, "_key", "left_semi")
        entries = _entries(_transitions(measured, block_lines, max_lines, max_chars),
                           last // block_lines + 1, fan_out, max_lines)
        # Logs of a single block have no entry: they begin at 0.
        entered = (blocks.join(entries, ["_key", "_block"], "left")
                         .fillna(0, ["_entry", "_index", "_chars"]))

    lines = entered.select(
        "_key", "_block", "_entry", "_index",
        F.slice("_values", F.col("_entry") + 1, F.greatest(F.size("_values") - F.col("_entry"), F.lit(0)))
         .alias("_lines"),
        (F.col("_chars") + F.aggregate(F.slice("_values", F.lit(1), F.col("_entry")), zero,
                                       lambda total, line: total + F.length(line) + 1)).alias("_chars"))
    # Lines behind the block only complete its last chunk; chunks that begin there are not its.
    spans = lines.withColumn("_spans", F.filter(
        _spans(F.transform("_lines", F.length), max_lines, max_chars),
        lambda s: s["first"] + F.col("_entry") < block_lines))
    chunks = spans.withColumn("_chunks", _messages(F.col("_lines"), F.col("_spans")))
    exploded = _explode_chunks(chunks, ["_key"], F.col("_index"),
                               F.col("_block") * block_lines + F.col("_entry"), F.col("_chars"))
    return exploded.select("_key.*", *exploded.columns[1:])


def _blocks(rows: DataFrame, block_lines: int, overhang: int, value: Column) -> DataFrame:
    """Array ``_values`` per block in line order, with the ``overhang`` lines behind the block."""
    block = F.expr(f"_at div {block_lines}")
    shared = (F.col("_at") % block_lines < overhang) & (block > 0)
    blocks = F.when(shared, F.array(block, block - 1)).otherwise(F.array(block))
    placed = rows.select("_key", F.explode(blocks).alias("_block"), "_at", value.alias("_value"))
    return (placed.groupBy("_key", "_block")
                  .agg(F.sort_array(F.collect_list(F.struct("_at", "_value"))).alias("_rows"))
                  .select("_key", "_block", F.col("_rows._value").alias("_values")))


def _transitions(rows: DataFrame, block_lines: int, max_lines: int, max_chars: int) -> DataFrame:
    """Per block: for each entry the entry into the next block
    (``exits``) and the number of chunks (``counts``); and the block's characters."""
    measured = rows.select(
        "_key", "_at", F.struct(F.length("line").alias("n"),
                                X.has_text(F.col("line")).alias("text")).alias("m"))

    @F.pandas_udf("struct<exits: array<int>, counts: array<bigint>>")
    def transition(lengths: pd.Series, has_text: pd.Series) -> pd.DataFrame:
        exits, counts = [], []
        for n, text in zip(lengths, has_text):
            known, own = len(n), min(len(n), block_lines)
            ends = np.concatenate(([0], np.cumsum(np.asarray(n, np.int64) + 1)))
            texts = np.concatenate(([0], np.cumsum(np.asarray(text, bool))))
            at = np.arange(own)
            by_length = np.searchsorted(ends, ends[at] + max_chars + 1) - 1
            following = np.minimum(np.maximum(by_length, at + 1), np.minimum(at + max_lines, known))
            # All entries at once, chunk by chunk, until the last of them has left the block.
            entry, total = np.arange(max_lines), np.zeros(max_lines, np.int64)
            while (inside := entry < own).any():
                here = entry[inside]
                total[inside] += texts[following[here]] > texts[here]
                entry[inside] = following[here]
            # What leaves the last block, which is not followed by another, leads nowhere.
            exits.append(np.clip(entry - block_lines, 0, max_lines - 1).astype(np.int32))
            counts.append(total)
        return pd.DataFrame({"exits": exits, "counts": counts})

    table = _blocks(measured, block_lines, max_lines, F.col("m")).select(
        "_key", "_block", transition("_values.n", "_values.text").alias("t"),
        F.aggregate(F.slice("_values.n", 1, block_lines), F.lit(0).cast("bigint"),
                    lambda total, n: total + n + 1).alias("chars"))
    return materialize(table.select("_key", "_block", "t.exits", "t.counts", "chars"), "blocks")


def _entries(level: DataFrame, n_blocks: int, fan_out: int, width: int) -> DataFrame:
    """Per block its ``_entry`` and the chunks and characters before it.

    ``fan_out`` blocks at a time are composed to one block of the next level; the entries are
    then handed down level by level. So no task sees more than ``fan_out`` tables.
    """
    kids = level.groupBy("_key", F.expr(f"_block div {fan_out}").alias("_group")).agg(
        F.sort_array(F.collect_list(F.struct("_block", "exits", "counts", "chars"))).alias("kids"))
    flat = kids.select("_key", "_group", "kids", F.flatten("kids.exits").alias("exits"),
                       F.flatten("kids.counts").alias("counts"))

    @F.pandas_udf("struct<exits: array<int>, counts: array<bigint>>")
    def compose(exits: pd.Series, counts: pd.Series) -> pd.DataFrame:
        out = {"exits": [], "counts": []}
        for e, c in zip(exits, counts):
            entry, total = np.arange(width), np.zeros(width, np.int64)
            for exit_of, chunks in zip(e.reshape(-1, width), c.reshape(-1, width)):
                total = total + chunks[entry]
                entry = exit_of[entry]
            out["exits"].append(entry.astype(np.int32))
            out["counts"].append(total)
        return pd.DataFrame(out)

    @F.pandas_udf("struct<entries: array<int>, chunks: array<bigint>, chars: array<bigint>>")
    def walk(entry: pd.Series, exits: pd.Series, counts: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        out = {"entries": [], "chunks": [], "chars": []}
        for at, e, c, size in zip(entry, exits, counts, sizes):
            entries, chunks = np.zeros(len(size), np.int32), np.zeros(len(size), np.int64)
            for k, exit_of in enumerate(e.reshape(-1, width)):
                entries[k], chunks[k], at = at, c[k * width + at], exit_of[at]
            out["entries"].append(entries)
            out["chunks"].append(np.cumsum(chunks) - chunks)
            out["chars"].append(np.cumsum(size) - size)
        return pd.DataFrame(out)

    zero = F.lit(0).cast("bigint")
    if n_blocks <= fan_out:
        parents = flat.select("*", F.lit(0).alias("_entry"), zero.alias("_index"), zero.alias("_chars"))
    else:
        total = F.aggregate("kids.chars", zero, lambda a, b: a + b)
        upper = flat.select("_key", F.col("_group").alias("_block"),
                            compose("exits", "counts").alias("t"), total.alias("chars"))
        upper = materialize(upper.select("_key", "_block", "t.exits", "t.counts", "chars"), "blocks")
        above = _entries(upper, -(-n_blocks // fan_out), fan_out, width)
        parents = flat.join(above.withColumnRenamed("_block", "_group"), ["_key", "_group"])

    walked = parents.select(
        "_key", "_index", "_chars", F.col("kids._block").alias("blocks"),
        walk("_entry", "exits", "counts", "kids.chars").alias("w"))
    rows = walked.select("_key", "_index", "_chars", F.inline_outer(F.arrays_zip(
        "blocks", F.col("w.entries").alias("entries"), F.col("w.chunks").alias("chunks"),
        F.col("w.chars").alias("chars"))))
    return rows.select("_key", F.col("blocks").alias("_block"), F.col("entries").alias("_entry"),
                       (F.col("_index") + F.col("chunks")).alias("_index"),
                       (F.col("_chars") + F.col("chars")).alias("_chars"))
