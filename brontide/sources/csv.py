"""CSV landing files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from brontide.operators.project import column
from brontide.sources import files, large_csv

# Quotes are escaped by doubling and a quoted field may hold line breaks. The timestamp
# formats keep microseconds, which the default formats drop on writing.
_DIALECT = {
    "header": True,
    "escape": '"',
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Characters of a value that is no text, at most in general; times that the widest row may have the mean width of all.
_WIDEST, _ALIKE = 24, 16
# Bytes of text from which a landing is compressed; bytes of text that one of a compressed file counts as.
PACK_FROM, _PACKED = 1 << 28, 3
_COMPRESSED = (".gz", ".bz2", ".zst", ".xz", ".snappy", ".lz4", ".deflate")


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header CSV, a file or a folder of files.

    Without a schema the types are inferred, at the price of one more pass over the data. With
    one, a value that does not fit its type fails the read rather than turn into NULL. A file larger
    than a split (``spark.sql.files.maxPartitionBytes``) is read by many tasks, see ``large_csv``; others by one each.
    """
    if _largest_file(spark, path) > _bytes_of(spark, "spark.sql.files.maxPartitionBytes"):
        return large_csv.scan(spark, path, _DIALECT, schema)
    reader = spark.read.options(**_DIALECT, multiLine=True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.options(mode="FAILFAST", enforceSchema=False).schema(schema).csv(path)


def _bytes_of(spark: SparkSession, name: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))


def _largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file that can be split: a compressed one cannot."""
    sizes = files.list_sizes(spark, path)
    return max((n for name, n in sizes if not name.endswith(_COMPRESSED)), default=0)


def text_bytes(spark: SparkSession, path: str) -> int:
    """About how many bytes of text a landing has, however it is stored."""
    return sum(n * (_PACKED if name.endswith(_COMPRESSED) else 1) for name, n in files.list_sizes(spark, path))


def in_files(df: DataFrame, most_rows: int = 1_000_000) -> tuple[DataFrame, int]:
    """``df`` and the rows of a file, see ``landing``."""
    return landing(df, most_rows)[:2]


def landing(df: DataFrame, most_rows: int = 1_000_000) -> tuple[DataFrame, int, int]:
    """``df``, the rows of a file, so that each file has about ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` of text at most, and
    the bytes of text of all of them, by the width that numbers have at most.

    Where rows are of a like width, partitions are cut into files as they are, by the mean width of a row, and nothing
    is shuffled. Where a row may be much wider than the mean, rows are dealt out by bytes first, in partitions of that size. To be
    applied before rows are counted, as counts belong directly below the sink.
    """
    texts = [F.coalesce(F.octet_length(column(f.name)), F.lit(0)) for f in df.schema if isinstance(f.dataType, T.StringType)]
    fixed = len(df.columns) + _WIDEST * (len(df.columns) - len(texts))
    width = reduce(Column.__add__, texts, F.lit(0))
    mean, most, n_rows = (x or 0 for x in df.agg(F.avg(width), F.max(width), F.count(F.lit(1))).first())
    total = int(n_rows * (fixed + mean))
    size = _bytes_of(df.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    if fixed + most > _ALIKE * (fixed + mean):
        return df.hint("rebalance"), most_rows, total
    return df, max(1, min(most_rows, int(size / (fixed + mean)))), total


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000, packed: bool = False) -> None:
    """Write ``df`` as a folder of header CSV files; NULL becomes an empty field.

    A file with quoted line breaks is dear to split between tasks, so files are kept small enough
    for one: by bytes where ``df`` and ``rows_per_file`` come from ``landing``, and by rows in any case. With ``packed`` they are
    compressed by gzip, at a level near its fastest: the next ones save a tenth for two to three times the work.
    """
    # A lone empty field would be an empty line, which readers skip: quote it.
    empty = '""' if len(df.columns) == 1 else ""
    (df.write.mode("overwrite")
       .options(**_DIALECT, nullValue=empty, emptyValue=empty,
                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                maxRecordsPerFile=rows_per_file,
                **({"compression": "gzip", "zlib.compress.level": "THREE"} if packed else {}))
       .csv(path))
