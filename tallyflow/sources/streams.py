"""One stream reader with two formats.

``files``  readStream over parquet / json / text files with an explicit
           schema; ``max_files_per_trigger`` / ``max_bytes_per_trigger`` rate
           limit each micro-batch (T10).
``kafka``  readStream from a topic; ``starting_offsets`` is explicit
           (``latest`` for S2/S3). Needs the spark-sql-kafka package on the
           cluster; it is not present on this machine, so this branch is not
           exercised by the tests.

``text`` files and ``kafka`` return string columns ``key`` (may be null) and
``value``; ``json`` / ``parquet`` files return their schema's columns, with
``value_col`` (when given) renamed to ``value``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.sinks import textfile


@dataclass
class StreamSpec:
    format: str = "files"                   # "files" | "kafka"
    path: str | None = None                 # files: folder to watch
    file_format: str = "text"               # files: text | json | parquet
    schema: object = None                   # files: StructType or DDL
    value_col: str | None = None            # files: column holding the message
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: str | None = None
    bootstrap_servers: str | None = None    # kafka
    topic: str | None = None                # kafka
    starting_offsets: str = "latest"        # kafka
    max_offsets_per_trigger: int | None = None
    options: dict = field(default_factory=dict)


def file_spec(spark: SparkSession, path: str, **spec) -> StreamSpec:
    """The spec of a table kept as a folder of files or as a single file (a
    stream reads folders, so a file is its folder narrowed to that name)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile():
        return StreamSpec(path=p.getParent().toString(), options={"pathGlobFilter": p.getName()}, **spec)
    return StreamSpec(path=path, **spec)


def in_slices(df: DataFrame, col, n: int, column: str = "_slice") -> DataFrame:
    """``df`` with the number 0..n-1 of the equal stretch of ``col`` (a whole
    number) that a row lies in; nulls go first."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    place = F.lit(0) if lo is None else F.coalesce(F.floor((col - F.lit(lo)) * n / F.lit(hi - lo + 1)), F.lit(0))
    return df.withColumn(column, place.cast("int"))


FEED_FILE_BYTES = 2 << 20       # about the size of a feed's files


def write_feed(df: DataFrame, path: str, n: int, files: int | None = None, column: str = "_slice") -> StreamSpec:
    """A feed in a known order: the slices 0..n-1 of ``df`` (in ``column``) are
    written one after the other, ``files`` files each, and the spec reads
    ``files`` files a micro-batch (T10), so each slice is a micro-batch of its
    own, as a file stream takes files by the time of their writing.

    ``df`` is evaluated once, into ``<path>-slices``, which is deleted at the
    end. By default there are so many files that one of the largest slice has
    about ``FEED_FILE_BYTES``: no task writes or reads a whole slice. A slice with
    too few rows for that many files is filled up with empty ones."""
    spark, (folder, name) = df.sparkSession, path.rstrip("/").rsplit("/", 1)
    staged, schema = f"{name}-slices", df.drop(column).schema
    df.write.mode("overwrite").partitionBy(column).parquet(f"{folder}/{staged}")
    if files is None:
        sizes = [sum(textfile.data_files(spark, folder, f"{staged}/{column}={k}/*.parquet").values()) for k in range(n)]
        files = max(1, *(math.ceil(b / FEED_FILE_BYTES) for b in sizes))
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{folder}/{staged}/{column}=-1")
    empty, = textfile.data_files(spark, folder, f"{staged}/{column}=-1/*.parquet")
    slices = spark.read.schema(df.schema).parquet(f"{folder}/{staged}")
    there = len(textfile.data_files(spark, folder, f"{name}/*.parquet"))
    for k in range(n):
        slices.where(F.col(column) == k).select(*schema.names).repartition(files).write.mode("append").parquet(path)
        there += files
        for i in range(len(textfile.data_files(spark, folder, f"{name}/*.parquet")), there):
            textfile.copy(spark, empty, f"{folder}/{name}", f"empty-{i}.parquet")
    textfile.delete(spark, folder, staged)
    return StreamSpec(path=path, file_format="parquet", schema=schema, max_files_per_trigger=files)


def read_stream(spark: SparkSession, spec: StreamSpec) -> DataFrame:
    if spec.format == "files":
        r = spark.readStream.format(spec.file_format)
        if spec.file_format != "text":
            if spec.schema is None:
                raise ValueError("files streams need an explicit schema")
            r = r.schema(spec.schema)
        if spec.max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", spec.max_files_per_trigger)
        if spec.max_bytes_per_trigger:
            r = r.option("maxBytesPerTrigger", spec.max_bytes_per_trigger)
        for k, v in spec.options.items():
            r = r.option(k, v)
        df = r.load(spec.path)
        if spec.file_format == "text":
            return df.select(F.lit(None).cast("string").alias("key"), F.col("value"))
        if spec.value_col:
            return df.withColumnRenamed(spec.value_col, "value")
        return df
    if spec.format == "kafka":
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", spec.bootstrap_servers)
             .option("subscribe", spec.topic)
             .option("startingOffsets", spec.starting_offsets))
        if spec.max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", spec.max_offsets_per_trigger)
        for k, v in spec.options.items():
            r = r.option(k, v)
        return r.load().selectExpr("CAST(key AS STRING) AS key",
                                   "CAST(value AS STRING) AS value")
    raise ValueError(f"unknown stream format {spec.format!r}")
