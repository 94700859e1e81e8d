"""Binary files through Spark's own file writer and reader.

Executors write raw bytes with the committer of a normal Spark job, so a lost
executor or a retried task leaves no half file, and any file system that Spark
knows will do. One row is one file: the text writer puts out the row's bytes
and then its line separator, so the separator is set to the fixed last bytes
(``tail``) that every file of the format ends with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_files(blobs: DataFrame, path: str, tail: bytes) -> None:
    """Write each row of the binary column ``blob`` as one file under ``path``.

    Every blob must end with ``tail``; null blobs are left out. Files of a
    partition are numbered in row order.
    """
    body = F.expr(f"substring(blob, 1, length(blob) - {len(tail)})").cast("string")
    (blobs.where("blob is not null").select(body.alias("value")).write
     .option("encoding", "ISO-8859-1").option("lineSep", tail.decode("latin-1"))
     .option("compression", "none").option("maxRecordsPerFile", 1).text(path))


def read_files(spark: SparkSession, path: str, tail: bytes | None = None) -> DataFrame:
    """The files under ``path`` as rows (``path``, ``content``).

    A partition without rows leaves a file without content; those are left
    out, as are files of nothing but ``tail``.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length", "content")
    return files.where(F.col("length") > (len(tail) if tail else 0)).select("path", "content")
