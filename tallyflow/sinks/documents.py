"""K1: daily-index document sink (IDs K1, P6, P9, C10, C11, C16).

The reference sends one request per count record to a document store, into
index ``logcount-yyyy.MM.dd`` with type ``info`` and an ``@timestamp`` of the
write time. Here the documents are rows; the sink writes them as JSON files
partitioned by ``_index`` (readers prune by day), batch or stream. A
document-store connector can be plugged in through ``format``/``options``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.timecols import index_name, write_time

# Index prefix and document type of the reference's sink.
INDEX_PREFIX = "logcount-"
DOC_TYPE = "info"


def index_documents(rows: DataFrame, day_col: str | None = None,
                    prefix: str = INDEX_PREFIX, doc_type: str = DOC_TYPE,
                    stamp_write_time: bool = True) -> DataFrame:
    """Rows -> documents: adds ``_index`` (from ``day_col``, or from the
    write time as the reference does when None), ``_type`` and
    ``@timestamp`` (write time, when ``stamp_write_time``)."""
    day = F.col(day_col) if day_col else write_time()
    out = rows.withColumn("_index", index_name(day, prefix)).withColumn("_type", F.lit(doc_type))
    if stamp_write_time:
        out = out.withColumn("@timestamp", write_time())
    return out


def write_documents(docs: DataFrame, path: str, mode: str = "overwrite",
                    format: str = "json", options: dict | None = None) -> None:
    """Batch write, one folder per index day. By default the days that
    ``docs`` holds are replaced and others stay, so a re-run leaves each
    document once; ``mode="append"`` adds to them."""
    (docs.write.mode(mode).format(format).option("partitionOverwriteMode", "dynamic")
     .options(**(options or {})).partitionBy("_index").save(path))


def write_documents_batch(docs: DataFrame, path: str, batch_id: int, format: str = "json",
                          options: dict | None = None, output_files: int | None = None) -> None:
    """The documents of one micro-batch, under ``_index=<day>/batch_id=<id>``:
    a replayed batch replaces its own folders. ``output_files`` bounds the
    files per day."""
    if output_files:
        docs = docs.coalesce(output_files)
    (docs.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").format(format)
     .option("partitionOverwriteMode", "dynamic").options(**(options or {}))
     .partitionBy("_index", "batch_id").save(path))


# Reasons for which a document is refused.
NO_DAY = "no index day"
TOO_LARGE = "too large"


def refusal(docs: DataFrame, max_bytes: int | None = None, required: dict[str, str] | None = None) -> Column:
    """Why a document cannot be indexed (null: it can): it has no ``_index``,
    lacks a required field (``required``: field -> reason), or its JSON is larger
    than ``max_bytes``. The first reason in this order counts."""
    why = F.when(F.col("_index").isNull(), NO_DAY)
    for field, reason in (required or {}).items():
        why = why.when(F.col(f"`{field}`").isNull(), reason)
    if max_bytes is not None:
        why = why.when(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))) > max_bytes, TOO_LARGE)
    return why


def write_or_refuse(docs: DataFrame, path: str, dead_path: str, batch_id: int, format: str = "json",
                    options: dict | None = None, max_bytes: int | None = None,
                    required: dict[str, str] | None = None) -> None:
    """K1 with failed documents: those that can be indexed are written as by
    ``write_documents_batch``; each other one goes to ``dead_path`` with its
    reason, as the JSON text of the document, and the batch goes on. Both
    outputs are folders of the batch, so a replay leaves each document once.
    A replay that refuses nothing empties the batch's folder of refused ones.
    """
    marked = docs.withColumn("_refused", refusal(docs, max_bytes, required)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_documents_batch(marked.where("_refused IS NULL").drop("_refused"), path, batch_id, format, options)
        document = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
        (marked.where("_refused IS NOT NULL").select(document.alias("document"), F.col("_refused").alias("reason"))
         .write.mode("overwrite").parquet(f"{dead_path}/batch_id={batch_id}"))
    finally:
        marked.unpersist()
