"""Numbered commits: small files of which each is created once, by one writer.

Two writers that take the same number meet at the file system: one creates the file, the other finds it there and goes on with
the next number. Nothing that was committed is lost.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from brontide.sources import files


def create_exclusively(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content, unless there is one; whether it was created.

    The content is written under another name first, and that file is then given its name, which fails where the name is
    taken: by a link on local disks, by a rename without overwriting elsewhere. The file system must do that
    atomically, as HDFS does.
    """
    system, target = files.file_system(spark, path)
    _, draft = files.file_system(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.draft")
    out = system.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    try:
        if system.getUri().getScheme() == "file":
            local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(target), local(draft))
        else:
            rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
            context.rename(draft, target, spark._sc._gateway.new_array(rename, 0))
        return True
    except Py4JJavaError as error:
        if "AlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        system.delete(draft, False)


def versions(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """Numbers and names of the commits in a folder, in order."""
    found = ((re.search(r"(\d{20})\.json$", name), name) for name in files.list_names(spark, folder))
    return sorted((int(m[1]), name) for m, name in found if m)


def last(spark: SparkSession, folder: str) -> tuple[int, object]:
    """The number and content of the last commit; 0 and None where there is none."""
    while found := versions(spark, folder):
        try:
            return found[-1][0], json.loads(files.read_text(spark, f"{folder}/{found[-1][1]}"))
        except Py4JJavaError as error:
            # Pruned since it was listed: there is a later one.
            if "FileNotFound" not in error.java_exception.getClass().getName():
                raise
    return 0, None


def name_of(version: int) -> str:
    return f"{version:020d}.json"


def commit(spark: SparkSession, folder: str, content: Callable[[int], str]) -> int:
    """Add a commit with the next free number, for which ``content`` makes the text; returns the number."""
    while True:
        found = versions(spark, folder)
        version = found[-1][0] + 1 if found else 1
        if create_exclusively(spark, f"{folder}/{name_of(version)}", content(version)):
            return version
