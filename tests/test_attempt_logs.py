import hashlib

import pytest

from brontide.catalog.common import splits_of, write_small_logs
from brontide.operators.chunking import chunk_text
from brontide.plans import collect
from brontide.sources import attempt_logs as A

RUN = "manual__2024-01-01T00:00:00+00:00"
LOGS = {
    f"dag_id=d/run_id={RUN}/task_id=a/attempt=1.log": "one\ntwo\n",
    f"dag_id=d/run_id={RUN}/task_id=a/attempt=2.log": "x",
    f"dag_id=d/run_id={RUN}/task_id=m/map_index=0/attempt=1.log": "a\r\nb\x0bc\r\n\r\n",
    f"dag_id=d/run_id={RUN}/task_id=m/map_index=12/attempt=1.log": "a\x0b",
    f"dag_id=d x/run_id=r%1/task_id=t/attempt=1.log": "é 1 \n2\r3\r\r4\r",
    f"dag_id=d x/run_id=r%1/task_id=t/attempt=10.log": "a\n\x85",
    f"dag_id=d x/run_id=r%1/task_id=long/attempt=1.log": "".join(f"line {i}\n" for i in range(5000)),
    f"dag_id=d x/run_id=r%1/task_id=none/attempt=1.log": "",
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("logs")
    for name, text in LOGS.items():
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())
    return str(base)


def key(name):
    parts = dict(p.split("=", 1) for p in name.removesuffix(".log").split("/"))
    index = parts.get("map_index")
    return (parts["dag_id"], parts["run_id"], parts["task_id"], None if index is None else int(index),
            int(parts["attempt"]))


def test_whole_texts(spark, root):
    found = {tuple(r)[:5]: r["raw_text"] for r in A.scan_attempt_logs(spark, root).collect()}
    assert {k: v for k, v in found.items() if v} == {key(n): t for n, t in LOGS.items() if t}


@pytest.mark.parametrize("split_bytes", ["128m", "1000"])
def test_lines(spark, root, split_bytes):
    """Also when files are cut into many splits."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        found = {}
        for row in A.scan_attempt_lines(spark, root).collect():
            found.setdefault(tuple(row)[:5], []).append((row["line_no"], row["line"]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, text in LOGS.items():
        assert sorted(found.get(key(name), [])) == list(enumerate(text.splitlines(), start=1)), name


def test_chunks_of_files_equal_chunks_of_texts(spark, root):
    by_lines = collect.attempt_chunks(spark, root, 7, 60).select(*A.ATTEMPT_KEYS, "chunk_index", "line_start",
                                                                "line_end", "char_start", "char_end", "message")
    by_text = chunk_text(A.scan_attempt_logs(spark, root), "raw_text", 7, 60)
    assert sorted(map(tuple, by_lines.collect()), key=str) == sorted(map(tuple, by_text.collect()), key=str)
    assert by_text.count() > 700


def test_one_fingerprint_at_all_sizes(spark, tmp_path):
    """The hash of a log does not tell whether a cell could hold it, nor how it was split."""
    long = "".join(f"line {i} é\n" for i in range(300))
    texts = {("r", 1): [b"one\ntwo\n"], ("r", 2): [b"no end"], ("r", 3): ["﻿mark\r\n\r\nx\r".encode()], ("r", 5): [long.encode()],
             ("r", 6): [long.encode(), b"", b"more", b"\xff\xfe\n"], ("s", 1): [b"\n"], ("s", 2): [b"\n\n\x00a"], ("s", 3): ["﻿".encode()]}
    for (run, attempt), parts in texts.items():
        folder = tmp_path / "in" / f"dag_id=d/run_id={run}/task_id=t"
        if len(parts) > 1:
            folder /= f"attempt={attempt}.log"
        folder.mkdir(parents=True, exist_ok=True)
        for i, part in enumerate(parts):
            (folder / (f"part-{i}" if len(parts) > 1 else f"attempt={attempt}.log")).write_bytes(part)
    runs = spark.createDataFrame([("d", "r", 1), ("d", "s", 2)], "dag_id string, dag_run_id string, pipeline_run_id long")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    for cell, split in ((1 << 26, "128m"), (8, "600"), (0, "4000")):
        base = str(tmp_path / f"corpus-{cell}")
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            collect.append_attempts(spark, str(tmp_path / "in"), runs, base, 0, cell_bytes=cell)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        found.append({(r["dag_run_id"], r["try_number"]): r for r in collect.current_sources(spark, base).collect()})
    for key, parts in texts.items():
        text = b"".join(parts)
        for rows in found:
            assert (rows[key]["content_hash"], rows[key]["content_size_bytes"]) == (hashlib.sha256(text).hexdigest(), len(text)), key
    assert found[0]["r", 5]["raw_content"] == long and found[1]["r", 5]["raw_content"] is None
    assert {k: r["line_count"] for k, r in found[1].items()} == {k: r["line_count"] for k, r in found[2].items()}


def test_many_small_logs(spark, tmp_path):
    """Written like Spark's own writer does, whatever the keys; read by few tasks however many they are."""
    odd = [None, "", "a b", "r%1+x", "\u00e9:=", "x'\"[]{}^*?#\\", "a/b\t\x7f"]
    rows = [(k, i % 3 if i % 4 else None, text) for k in odd for i, text in enumerate(["t", None, "", "two\nlines", "t", "\u00e9"])]
    rows += [(f"run {i}", i, "x") for i in range(200)] + rows[:9]
    logs = spark.createDataFrame(rows, "run_id string, map_index int, value string").coalesce(1)
    keys = ["run_id", "map_index"]
    assert write_small_logs(logs, str(tmp_path / "own"), keys) == len(rows)
    logs.write.partitionBy(*keys).text(str(tmp_path / "spark"))

    def files(base):
        return sorted((str(f.parent.relative_to(base)), f.read_bytes()) for f in base.rglob("part-*"))

    assert files(tmp_path / "own") == files(tmp_path / "spark")
    with splits_of(spark, 1):
        found = A.scan_attempt_logs(spark, str(tmp_path / "own"))
        assert found.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism
        assert found.count() == len(files(tmp_path / "own")) > 8 * spark.sparkContext.defaultParallelism
