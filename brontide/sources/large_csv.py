"""One large CSV file by many tasks, quoted line breaks included.

Where a split of the file begins, a quoted field may be open, which nothing in the split tells. A line either leaves that as it is or
decides it, so each split is summed up by where it ends if it begins outside or inside a field; composed in the order of
the splits this gives the true beginning of each. Then every task puts together the records of its split. Only lines of records that
reach into the next split, or begin in the one before, are grouped, a record at a time.
"""

from __future__ import annotations

import bisect
import csv
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

# From inside a field: up to a quote that is not doubled.
_CLOSE = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')
# By file: the splits behind which it changes whether a field is open, whether it is then, and whether lines end in two characters.
Ends = dict[str, tuple[list[int], list[bool], bool]]


def stays_open(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line, if one was or was not at its beginning."""
    at = 0
    while True:
        if inside or line.startswith('"', at):
            closed = _CLOSE.match(line, at if inside else at + 1)
            if closed is None:
                return True
            at, inside = closed.end(), False
        # Behind a closing quote, and in a field without quotes, all up to the delimiter is plain text.
        at = line.find(",", at) + 1
        if not at:
            return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.col("value").alias("line"))


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """Runs of lines of one split."""
    for batch in batches:
        blocks = batch.column(1).to_numpy()
        files = batch.column(0).dictionary_encode()
        keys = files.indices.to_numpy()
        start = 0
        for end in [*((keys[1:] != keys[:-1]) | (blocks[1:] != blocks[:-1])).nonzero()[0] + 1, len(blocks)]:
            if end > start:
                yield (files.dictionary[keys[start]].as_py(), int(blocks[start])), batch.column(2).slice(start, end - start)
            start = end


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per split, and per batch it comes in: whether a field is open behind it, for both beginnings, and whether its first
    line ends in a carriage return."""
    out: dict[tuple[str, int], list[bool]] = {}
    for key, lines in _splits(batches):
        quoted = lines.filter(pc.match_substring(lines, '"')).to_pylist()
        state = out.setdefault(key, [False, True, lines[0].as_py().endswith("\r")])
        for line in quoted:
            state[:2] = [stays_open(line, x) for x in state[:2]]
    columns = [pa.array([k[0] for k in out], pa.string()), pa.array([k[1] for k in out], pa.int64()),
               *[pa.array([s[i] for s in out.values()], pa.bool_()) for i in range(3)]]
    yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "outside", "inside", "two"])


def open_ends(lines: DataFrame) -> Ends:
    """Where fields are open in each file.

    A row per split comes to the driver, of two numbers for some 128 MB of text; only changes are kept.
    """
    # Lines without a quote change nothing; of the first split the first line is looked at.
    rows = lines.filter(F.contains("line", F.lit('"')) | (F.col("block") == 0)).mapInArrow(
        _summed, "file string, block long, outside boolean, inside boolean, two boolean")
    found: Ends = {}
    state: dict[str, bool] = {}
    for r in rows.orderBy("file", "block").toLocalIterator():
        blocks, ends, _ = found.setdefault(r["file"], ([], [], r["block"] == 0 and r["two"]))
        before = state.get(r["file"], False)
        state[r["file"]] = r["inside"] if before else r["outside"]
        if state[r["file"]] != before:
            blocks.append(r["block"])
            ends.append(state[r["file"]])
    return found


def _begins_inside(ends: Ends, key: tuple[str, int]) -> bool:
    blocks, states, _ = ends.get(key[0], ([], [], False))
    at = bisect.bisect_left(blocks, key[1])
    return states[at - 1] if at else False


def _require_header(text: str, names: list[str] | None, file: str) -> None:
    found = next(csv.reader([text]), [])
    if names is not None and [x.strip().lower() for x in found] != [x.strip().lower() for x in names]:
        raise ValueError(f"the header of {file} is {found}, not {names}")


def records(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """``record``, the text of each record but the headers, of all files under ``path``.

    Records end with a line feed, or a carriage return and a line feed, outside of quoted fields; empty ones are
    left out. A header other than ``names`` fails.
    """
    lines = _lines(spark, path)
    ends = open_ends(lines)
    shared = spark.sparkContext.broadcast(ends)

    def put_together(batches: Iterator[pa.RecordBatch], fragments: bool) -> Iterator[pa.RecordBatch]:
        """Whole records, or the lines of those that are not whole in their split, by number and whether a record starts there."""
        states: dict[tuple[str, int], list] = {}
        for key, lines in _splits(batches):
            if key not in states:
                # The record that is open, whether it began in an earlier split, the lines so far, and whether it is the header.
                inside = _begins_inside(shared.value, key)
                states = {k: s for k, s in states.items() if fragments} | {key: [inside, inside, [], key[1] == 0 and not inside, 0]}
            yield from _of_split(key, lines, states[key], fragments)
        if fragments:
            for key, (inside, before, held, header, n) in states.items():
                if held:
                    yield _fragment(key, n, "\n".join(held), not before, header)

    def _fragment(key, n: int, text: str, starts: bool, header: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([n], pa.int64()), pa.array([text]),
                                           pa.array([starts]), pa.array([header]), pa.array([shared.value[key[0]][2]])],
                                          names=["file", "block", "n", "record", "starts", "header", "two"])

    def _of_split(key, lines: pa.Array, state: list, fragments: bool) -> Iterator[pa.RecordBatch]:
        whole: list[str] = []
        quoted = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
        texts = lines.to_pylist()
        at = 0
        while at < len(texts):
            inside, before, held, header, n = state
            if not inside and not held and not header and not quoted[at]:
                # Plain lines up to the next quote are records as they are.
                end = at + int(quoted[at:].argmax()) if quoted[at:].any() else len(texts)
                if not fragments:
                    whole += texts[at:end]
                at = end
                continue
            line = texts[at]
            at += 1
            inside = stays_open(line, inside) if quoted[at - 1] else inside
            if inside:
                held.append(line)
                state[0] = True
                continue
            text = "\n".join([*held, line])
            if held and shared.value[key[0]][2]:
                # As the plain reader does where the file's own line breaks are such.
                text = text.replace("\r\n", "\n")
            if before and fragments:
                yield _fragment(key, n, text, False, header)
            elif header:
                _require_header(text.removesuffix("\r"), names, key[0])
            elif not before and not fragments:
                whole.append(text)
            state[:] = [False, False, [], False, n + 1]
        if whole and not fragments:
            yield pa.RecordBatch.from_arrays([pa.array(whole, pa.string())], names=["record"])

    done = lines.mapInArrow(lambda batches: put_together(batches, False), "record string")
    if any(blocks for blocks, _, _ in ends.values()):
        # Splits that begin or end inside a field, whose lines alone are looked at once more.
        begins = F.udf(lambda file, block: _begins_inside(shared.value, (file, block)), T.BooleanType())
        splits = lines.select("file", "block").distinct().withColumn("inside", begins("file", "block"))
        follows = F.lead("inside").over(Window.partitionBy("file").orderBy("block"))
        touched = splits.withColumn("next", F.coalesce(follows, F.lit(True))).filter("inside or next").select("file", "block")
        chosen = {(r["file"], r["block"]) for r in touched.toLocalIterator()}
        picked = spark.sparkContext.broadcast(chosen)

        def only_touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                own = batch.filter(pa.array([k in picked.value for k in keys]))
                if len(own):
                    yield own

        parts = lines.mapInArrow(lambda batches: put_together(only_touched(batches), True),
                                 "file string, block long, n long, record string, starts boolean, header boolean, two boolean")
        number = F.sum(F.col("starts").cast("int")).over(Window.partitionBy("file").orderBy("block", "n").rowsBetween(Window.unboundedPreceding, 0))
        joined = parts.withColumn("_no", number).groupBy("file", "_no").agg(
            F.array_sort(F.collect_list(F.struct("block", "n", "record"))).alias("_parts"), F.max("header").alias("header"), F.max("two").alias("two"))
        text = F.array_join(F.transform("_parts", lambda p: p["record"]), "\n")
        text = F.when(F.col("two"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text)
        done = done.unionByName(joined.filter(~F.col("header")).select(text.alias("record")))
    # Text that ends in a carriage return behind the last quote ends in a line break of two characters.
    return done.select(F.regexp_replace("record", "\r\\z", "").alias("record")).filter("record <> ''")


def scan(spark: SparkSession, path: str, dialect: dict, schema: T.StructType | None = None) -> DataFrame:
    """The rows of all files under ``path``; with a schema, what does not fit it fails."""
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in dialect.items()} | {"multiLine": "true"}
    names = spark.read.options(**options).csv(path).columns if schema is None else schema.names
    rows = records(spark, path, names if schema is not None else None)
    if schema is None:
        jvm_rows = getattr(rows._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
        reader = spark.read.options(**options | {"header": "false", "inferSchema": "true"})._jreader
        kinds = DataFrame(reader.csv(jvm_rows), spark).schema
        schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, kinds)])
    parsed = rows.select(F.from_csv("record", F.lit(schema.toDDL()), options | {"mode": "FAILFAST"}).alias("_row"))
    return parsed.select("_row.*")
