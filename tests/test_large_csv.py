"""Large CSV files by splits against the plain reader."""

import csv
import io
import random

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from brontide.sources import csv as C, large_csv
from brontide.sources.large_csv import stays_open

SCHEMA = "id int, text string, more string"


@pytest.fixture
def small_splits(spark):
    """Splits of a few bytes; to be given their size."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    before = {n: spark.conf.get(n, None) for n in names}

    def use(size):
        for n, v in zip(names, (size, 1, 1)):
            spark.conf.set(n, v)
    yield use
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def rows_of(spark, path, schema=SCHEMA):
    parsed = spark.createDataFrame([], schema).schema if schema else None
    return sorted(map(tuple, C.scan_csv(spark, path, parsed).collect()), key=str)


def plain(spark, path, schema=SCHEMA):
    reader = spark.read.options(**C._DIALECT, multiLine=True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return sorted(map(tuple, reader.csv(path).collect()), key=str)


def tricky(seed, n, end="\n"):
    rng = random.Random(seed)
    out = io.StringIO()
    out.write(f"id,text,more{end}")
    for i in range(n):
        text = "".join(rng.choice(['a', '"', ",", "\n", "\r\n", "é", " b", "\n\n", '","', '"\n"']) for _ in range(rng.randrange(9)))
        more = rng.choice(["", "x", '5" pipe', "q" * 30])
        quoted = '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\r\n') or rng.random() < 0.3 else text
        out.write(f"{i},{quoted},{more}{end}")
        if rng.random() < 0.1:
            out.write(end)
    return out.getvalue()


@pytest.mark.parametrize("size, end", [(3, "\n"), (17, "\r\n"), (64, "\n"), (257, "\r\n")])
def test_every_split_gives_the_rows_of_the_plain_reader(spark, tmp_path, small_splits, size, end):
    path = str(tmp_path / "t.csv")
    for seed in range(2):
        with open(path, "w", newline="") as out:
            out.write(tricky(seed, 60, end).removesuffix(end if seed else ""))
        expected = plain(spark, path)
        small_splits(size)
        assert spark.read.text(path).rdd.getNumPartitions() > 3
        assert rows_of(spark, path) == expected and len(expected) == 60
        small_splits(1 << 27)


def test_folder_of_files_types_and_headers(spark, tmp_path, small_splits):
    folder = tmp_path / "t"
    folder.mkdir()
    for i in range(3):
        with open(folder / f"{i}.csv", "w", newline="") as out:
            out.write(tricky(i, 40))
    expected, inferred = plain(spark, str(folder)), plain(spark, str(folder), None)
    small_splits(50)
    assert rows_of(spark, str(folder)) == expected
    found = C.scan_csv(spark, str(folder))
    assert found.dtypes == [("id", "int"), ("text", "string"), ("more", "string")]
    assert sorted(map(tuple, found.collect()), key=str) == inferred
    with pytest.raises(Exception, match="header"):
        rows_of(spark, str(folder), "id int, text string, other string")
    with pytest.raises(Exception):
        rows_of(spark, str(folder), "id int, text int, more string")


def test_field_over_many_splits_and_without_end(spark, tmp_path, small_splits):
    path = str(tmp_path / "t.csv")
    long = "\n".join(f"line {i}, with a comma" for i in range(200))
    with open(path, "w", newline="") as out:
        out.write(f'id,text,more\n1,"{long}",x\n2,b,y\n3,"{long}\n""",z\n')
    small_splits(64)
    assert rows_of(spark, path) == [(1, long, "x"), (2, "b", "y"), (3, long + '\n"', "z")]
    with open(path, "a", newline="") as out:
        out.write('4,"never closed\n5,c,d\n')
    with pytest.raises(Exception):
        rows_of(spark, path)


def test_header_longer_than_a_split(spark, tmp_path, small_splits):
    path = str(tmp_path / "t.csv")
    with open(path, "w", newline="") as out:
        out.write('id,"long\nname ""of"" it",more\n1,"a\nb",c\n')
    small_splits(8)
    found = C.scan_csv(spark, path)
    assert found.columns == ["id", 'long\nname "of" it', "more"] and [tuple(r) for r in found.collect()] == [(1, "a\nb", "c")]


def test_records_are_not_shuffled(spark, tmp_path, small_splits):
    """Only fragments of records that cross a split are grouped."""
    path = str(tmp_path / "t.csv")
    with open(path, "w", newline="") as out:
        out.write(tricky(1, 500))
    small_splits(1000)
    lines = large_csv.records(spark, path)
    fragments = large_csv._lines(spark, path)
    ends = large_csv.open_ends(fragments)
    assert sum(len(x) for x, _, _ in ends.values()) < 40
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1 and "Join" not in plan


@given(st.lists(st.sampled_from(["a", '"', '""', ",", "\n", "x y"]), max_size=25).map("".join))
def test_state_of_a_line_is_that_of_the_text(text):
    """Line by line as in one go, for text that a writer could have made."""
    record = io.StringIO()
    csv.writer(record, lineterminator="\n").writerow([text, "b", text])
    inside, ends = False, []
    for line in record.getvalue().split("\n")[:-1]:
        inside = stays_open(line, inside)
        ends.append(inside)
    assert not ends[-1] and all(ends[:-1])
