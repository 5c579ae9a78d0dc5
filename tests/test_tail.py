"""Growing files: every complete line once, through growth, rotation, truncation and restarts."""

import random
import time

import pytest

from brontide.session import work_dir
from brontide.streaming import tail


def collect(spark, folder, state, **options):
    """One run of a query that keeps its lines in a table."""
    stream = tail.read_growing_lines(spark, str(folder), **options)
    query = (stream.writeStream.format("parquet").option("path", f"{state}/out").option("checkpointLocation", f"{state}/ck")
                   .trigger(availableNow=True).start())
    query.awaitTermination()
    return sorted(r["line"] for r in spark.read.schema("line string").parquet(f"{state}/out").collect())


def test_files_that_grow(spark, tmp_path):
    folder, state = tmp_path / "in", work_dir(spark, "test-tail")
    folder.mkdir()
    a, b, c = (folder / f"{x}.log" for x in "abc")
    a.write_bytes(b"a1\na2\na-unfin")
    b.write_bytes(b"b1\r\nb2\n\n")
    c.write_bytes(b"c-first\nc-second\n")
    (folder / "_hidden").write_bytes(b"no\n")
    seen = ["a1", "a2", "b1", "b2", "", "c-first", "c-second"]
    assert collect(spark, folder, state) == sorted(seen)
    # Grows; rotated by renaming after it grew; truncated and shorter.
    a.write_bytes(b"a1\na2\na-unfinished\na4\n\xff\xc3\xa9\n")
    b.rename(folder / "b.log.1")
    with open(folder / "b.log.1", "ab") as out:
        out.write(b"b3\n")
    b.write_bytes(b"new b\n")
    c.write_bytes(b"c-third\n")
    seen += ["a-unfinished", "a4", "�é", "b3", "new b", "c-third"]
    assert collect(spark, folder, state) == sorted(seen)
    assert collect(spark, folder, state) == sorted(seen)
    # Truncated and longer than before; gone; another file in a folder below.
    c.write_bytes(b"c-after\n" * 3)
    a.unlink()
    (folder / "x").mkdir()
    (folder / "x" / "d.log").write_bytes(b"d1\nd2")
    seen += ["c-after"] * 3 + ["d1"]
    assert collect(spark, folder, state) == sorted(seen)


def test_no_folder_yet(spark, tmp_path):
    state = work_dir(spark, "test-tail")
    assert collect(spark, tmp_path / "none", state) == []


@pytest.mark.parametrize("size", [1, 2, 7, 64, 10_000])
def test_ranges_meet_at_any_byte(tmp_path, size):
    """Whatever the ranges, each line belongs to exactly one."""
    rng = random.Random(size)
    lines = ["x" * rng.choice([0, 1, 2, 5, 40]) + str(i) for i in range(60)]
    (tmp_path / "f").write_text("\n".join(lines) + "\nunfinished")
    reader = tail._Reader({"path": str(tmp_path), "rangebytes": str(size)})
    end = reader.latestOffset()
    parts = reader.partitions({}, end)
    rows = [(p, line) for part in parts for batch in reader.read(part) for p, line in zip(batch["position"].to_pylist(), batch["line"].to_pylist())]
    at, places = 0, []
    for line in lines:
        places.append(at)
        at += len(line) + 1
    assert rows == list(zip(places, lines))


def test_a_range_reads_little_more_than_itself(tmp_path, monkeypatch):
    (tmp_path / "f").write_text("a line of a long file\n" * 400_000)
    reader, sizes = tail._Reader({"path": str(tmp_path), "rangebytes": str(1 << 16)}), []

    class Counted:
        def __init__(self, stream):
            self.stream = stream

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.stream.close()

        def seek(self, at):
            self.stream.seek(at)

        def read(self, n):
            sizes.append(n)
            return self.stream.read(n)

    opened = reader._open
    monkeypatch.setattr(reader, "_open", lambda *a: Counted(opened(*a)))
    part = reader.partitions({}, reader.latestOffset())[3]
    assert sum(len(b) for b in reader.read(part)) == len(range(-(-part.start // 22), -(-part.end // 22)))
    assert sum(sizes) <= 3 << 16


def offset(folder):
    return tail._Reader({"path": str(folder)}).latestOffset()


def test_positions(tmp_path):
    f, g = tmp_path / "f", tmp_path / "g"
    f.write_text("one line of text\n" * 400)
    start = offset(tmp_path)
    f.write_text("one line of text\n" * 500)
    assert tail.ranges(start, offset(tmp_path)) == [(str(f), 6800, 8500)]
    # A copy that is there before the original is truncated, and after.
    g.write_text("one line of text\n" * 500)
    assert tail.ranges(start, offset(tmp_path)) == [(str(f), 6800, 8500)]
    f.write_text("")
    assert tail.ranges(start, offset(tmp_path)) == [(str(g), 6800, 8500)]
    # Other bytes at the start are another file, even if it is longer.
    f.write_text("One line of text\n" * 600)
    g.unlink()
    assert tail.ranges(start, offset(tmp_path)) == [(str(f), 0, 10200)]


def test_rotated_between_plan_and_read(tmp_path):
    f = tmp_path / "f"
    f.write_text("a\nb\n")
    reader = tail._Reader({"path": str(tmp_path)})
    part, = reader.partitions({}, reader.latestOffset())
    f.rename(tmp_path / "f.1")
    f.write_text("other\n")
    assert [line for batch in reader.read(part) for line in batch["line"].to_pylist()] == ["a", "b"]
    (tmp_path / "f.1").unlink()
    with pytest.raises(FileNotFoundError):
        list(reader.read(part))
    assert list(tail._Reader({"path": str(tmp_path), "missing": "skip"}).read(part)) == []


def test_long_file_is_read_in_ranges(spark, tmp_path):
    folder, state = tmp_path / "in", work_dir(spark, "test-tail")
    folder.mkdir()
    (folder / "big.log").write_text("".join(f"line {i}\n" for i in range(200_000)) + "x" * 5_000_000 + "\n")
    start = time.time()
    found = collect(spark, folder, state, rangeBytes=1 << 18)
    assert found == sorted([f"line {i}" for i in range(200_000)] + ["x" * 5_000_000])
    assert time.time() - start < 120
