"""Small text files on any Hadoop file system, replaced in one step."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, folder: str, name: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder, name)
    return jvm, conf, path, path.getFileSystem(conf)


def read_text(spark: SparkSession, folder: str, name: str) -> str | None:
    """The file's text, None where there is none."""
    jvm, _, path, fs = _open(spark, folder, name)
    if not fs.exists(path):
        return None
    f = fs.open(path)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(f, "UTF-8")
    finally:
        f.close()


def replace_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Write the file beside its place and move it there: readers see the old
    text or the new one."""
    jvm, conf, path, fs = _open(spark, folder, name)
    new = jvm.org.apache.hadoop.fs.Path(folder, name + ".new")
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf).rename(new, path, how)


def data_files(spark: SparkSession, folder: str, pattern: str) -> dict[str, int]:
    """The files of a folder that match, with their bytes."""
    _, _, path, fs = _open(spark, folder, pattern)
    return {f.getPath().toString(): f.getLen() for f in fs.globStatus(path) or []}


def data_bytes(spark: SparkSession, folder: str, name: str) -> int:
    """Bytes of the Parquet files in a folder of bucket folders."""
    return sum(data_files(spark, folder, f"{name}/*/*.parquet").values())


def copy(spark: SparkSession, file: str, folder: str, name: str) -> None:
    jvm, conf, path, fs = _open(spark, folder, name)
    source = jvm.org.apache.hadoop.fs.Path(file)
    jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, fs, path, False, conf)


def delete(spark: SparkSession, folder: str, name: str) -> None:
    _, _, path, fs = _open(spark, folder, name)
    fs.delete(path, True)
