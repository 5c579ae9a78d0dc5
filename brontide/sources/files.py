"""Files and folders on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists."""
    system, jvm_path = file_system(spark, path)
    return system.exists(jvm_path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds; nothing where there is none."""
    system, jvm_path = file_system(spark, path)
    system.delete(jvm_path, True)


def make_folder(spark: SparkSession, path: str) -> None:
    system, jvm_path = file_system(spark, path)
    system.mkdirs(jvm_path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    system, jvm_path = file_system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(jvm_path)) if system.exists(jvm_path) else []


def list_sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and bytes of the files that a reader of ``path``, a file, a folder or a pattern, would find."""
    system, jvm_path = file_system(spark, path)
    found = []
    for top in system.globStatus(jvm_path) or []:
        for s in system.listStatus(top.getPath()) if top.isDirectory() else [top]:
            name = s.getPath().getName()
            if s.isFile() and (not top.isDirectory() or not name.startswith(("_", "."))):
                found.append((name, s.getLen()))
    return found


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    system, jvm_path = file_system(spark, path)
    stream = system.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
