"""A streaming source of the lines of growing files, by byte position.

The offset is, for each file, the position behind its last complete line and digests of its first bytes. So a line is read once,
however often its file grows, and one that is not finished yet waits. A file whose first bytes changed, or which got
shorter, is another one and read from its start. If the bytes of a file that is gone turn up under another name, as after a
rotation by renaming, reading goes on there at the old position. A copy of a file of 4096 bytes or more begins where the
original has been read to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "growing-lines"
_SCHEMA = "file string, position bigint, line string"
# Lengths of the beginnings whose digests tell files apart.
_HEADS = [1 << i for i in range(13)]
_BLOCK = 1 << 16


def open_file_system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass(frozen=True)
class ByteRange(InputPartition):
    """The lines that start in ``[start, end)`` of a file; ``first`` and ``last`` bound what is read at all."""

    file: str
    start: int
    end: int
    first: int
    last: int
    heads: tuple[str, ...]


def _heads(stream, size: int) -> list[str]:
    """Digests of the first 1, 2, 4, ... of ``size`` bytes."""
    stream.seek(0)
    start = stream.read(min(size, _HEADS[-1]))
    return [hashlib.sha256(start[:n]).hexdigest()[:12] for n in _HEADS if n <= len(start)]


def _last_line_end(stream, size: int) -> int:
    """The position behind the last line feed; 0 if there is none."""
    at = size
    while at > 0:
        start = max(0, at - _BLOCK)
        stream.seek(start)
        found = stream.read(at - start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        at = start
    return 0


def _same(old: dict, new: dict) -> bool:
    """Whether ``new`` can be ``old`` some time later: no shorter, and alike as far as both are known."""
    n = min(len(old["heads"]), len(new["heads"]))
    return new["at"] >= old["at"] and old["heads"][:n] == new["heads"][:n]


def ranges(start: dict, end: dict) -> list[tuple[str, int, int]]:
    """``file, from, to`` of what ``end`` has more than ``start``."""
    gone = {name: x for name, x in start.items() if name not in end or not _same(x, end[name])}
    out = []
    for name in sorted(end):
        new = end[name]
        old = start.get(name)
        at = 0
        if old is not None and name not in gone:
            at = old["at"]
        else:
            # Renamed: of the files that are gone, the one known to the greatest length.
            before = max((n for n, x in gone.items() if n != name and x["heads"] and _same(x, new)), key=lambda n: (gone[n]["at"], n), default=None)
            # A copy, as made before its original is truncated: nothing is read twice.
            copied = max((min(x["at"], new["at"]) for n, x in end.items() if n in start and n not in gone and len(new["heads"]) == len(_HEADS)
                          and x["heads"] == new["heads"]), default=0)
            at = gone.pop(before)["at"] if before is not None else copied
        if at < new["at"]:
            out.append((name, at, new["at"]))
    return out


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.range_bytes = int(options.get("rangebytes", 64 << 20))
        self.skip_missing = options.get("missing", "fail") == "skip"
        self.seen: dict[tuple, dict] = {}

    def initialOffset(self) -> dict:
        return {}

    def _files(self) -> list[fs.FileInfo]:
        system, root = open_file_system(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        return [f for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))]

    def latestOffset(self) -> dict:
        system, _ = open_file_system(self.path)
        out, seen = {}, {}
        for info in self._files():
            key = (info.path, info.size, info.mtime_ns)
            entry = self.seen.get(key)
            if entry is None:
                try:
                    with system.open_input_file(info.path) as stream:
                        at = _last_line_end(stream, info.size)
                        entry = {"at": at, "heads": _heads(stream, at)}
                except FileNotFoundError:  # rotated away in between; found under its new name the next time
                    continue
            seen[key] = entry
            if entry["at"]:
                out[info.path] = entry
        self.seen = seen
        return out

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        return [ByteRange(name, at, min(at + self.range_bytes, to), a, to, tuple(end[name]["heads"]))
                for name, a, to in ranges(start, end) for at in range(a, to, self.range_bytes)]

    def _open(self, system: fs.FileSystem, part: ByteRange):
        """The file as it was planned: under its name, or under the one it was rotated to since."""
        # The planned name first, then the others, as long as none has the first bytes of the plan.
        for name in dict.fromkeys([part.file, *(f.path for f in self._files())]):
            try:
                stream = system.open_input_file(name)
            except FileNotFoundError:
                continue
            if stream.size() >= part.last and _heads(stream, part.last) == list(part.heads):
                return stream
            stream.close()
        if self.skip_missing:
            return None
        raise FileNotFoundError(f"{part.file} changed before its bytes {part.start} to {part.end} were read")

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        system, _ = open_file_system(self.path)
        stream = self._open(system, part)
        if stream is None:
            return
        with stream:
            # From the byte before, so that a line that starts right here is told from one that goes on.
            at = part.start if part.start == part.first else part.start - 1
            stream.seek(at)
            skip, rest = part.start > part.first, b""
            while at < part.end:
                # As far as the range goes, and then in growing steps to the end of its last line.
                held = at + len(rest)
                block = rest + stream.read(min(1 << 22, max(part.end - held, _BLOCK, len(rest)), part.last - held))
                if skip:
                    cut = block.find(b"\n") + 1
                    if not cut:
                        # The line before goes on; what is left of the range may hold no start at all.
                        at += len(block)
                        continue
                    at, block, skip = at + cut, block[cut:], False
                    if at >= part.end:
                        return
                whole = block.rfind(b"\n") + 1
                lines, rest = block[:whole].split(b"\n")[:-1], block[whole:]
                if not whole:
                    if at + len(rest) >= part.last:
                        return
                    continue
                places, texts = [], []
                for line in lines:
                    if at >= part.end:
                        break
                    places.append(at)
                    texts.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                    at += len(line) + 1
                yield pa.RecordBatch.from_arrays([pa.array([part.file] * len(places)), pa.array(places, pa.int64()), pa.array(texts, pa.string())],
                                                 names=["file", "position", "line"])


class GrowingLines(DataSource):
    """Options: ``path``, a folder; ``rangeBytes``, what a task reads at most; ``missing``, ``skip`` to go on where a file was
    truncated after its lines were planned and before they were read, which fails otherwise."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return _SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def read_growing_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """``file, position, line`` of all files in a folder and below it, as a stream."""
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format(FORMAT).option("path", path).options(**options).load()
