"""Exact dedup against a persistent digest index.

The index is a folder of files bucketed and sorted by digest, which other
sessions can open and add to, one at a time. New data is digested,
reduced to one row per digest, held against the index by a sort-merge
anti-join (the index side is read by bucket, without a shuffle) and its new
digests are appended. What was indexed first stays.

Two texts are equal when they are the same after lower-casing A-Z only; a null
text counts as empty. Within a batch the row with the largest doc_id stays
(null ids are smaller than all others). Rows that repeat both the doc_id and
the text are one document and get the same result. An empty batch adds
nothing. Columns other than doc_id and text play no part.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm.common import ascii_lower, join_groups, partitions, scratch, stage
from tallyflow.sinks import textfile


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the SHA-256 (32 bytes) of the normalised text."""
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))


LAYOUT = "_layout"


class DigestIndex:
    """A digest index kept under ``path``, a folder that all sessions share.

    The file ``_layout`` names the number of buckets, fixed when the index is
    made (default: the session's shuffle partitions), and the folder of the
    files; whoever opens the path again gets the same buckets. The session's
    catalog holds only a table over that folder, made on opening. A batch adds
    one file to a bucket; once a bucket may have ``most_files``, the index is
    compacted into a new folder, and the layout then names that one. The folder
    before it is deleted by the next compaction, so readers can finish.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, most_files: int = 16):
        self.spark, self.path = spark, (path or scratch(spark, "digest-index")).rstrip("/")
        self.buckets, self.most_files = buckets or partitions(spark), most_files
        self.name = f"digest_index_{uuid.uuid4().hex}"
        text = textfile.read_text(spark, self.path, LAYOUT)
        self.layout = json.loads(text) if text else None
        if self.layout:
            self.buckets = self.layout["buckets"]
            self._open()

    def _open(self) -> None:
        """The table over the layout's folder: reads and anti-joins by bucket."""
        self.close()
        self.spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
                       f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{self.path}/{self.layout['folder']}'")

    def close(self) -> None:
        """Forget the table; the index stays where it is."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _commit(self, **layout) -> None:
        self.layout = {"buckets": self.buckets, **layout}
        textfile.replace_text(self.spark, self.path, LAYOUT, json.dumps(self.layout))

    def read(self) -> DataFrame | None:
        return self.spark.table(self.name) if self.layout else None

    def add(self, batch: DataFrame) -> None:
        """Index the digests of ``batch`` (doc_id, digest) that are new."""
        new = batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        if self.layout is None:
            self._commit(folder="files-0", files=0, before=None)
            self._open()
        known = self.read()
        new = new.join(known.select("digest").hint("merge"), "digest", "left_anti")
        self._append(new.select("digest", "keep_id"), self.name)
        self._commit(**{k: self.layout[k] for k in ("folder", "before")}, files=self.layout["files"] + 1)
        if self.layout["files"] >= self.most_files:
            self.compact()

    def _append(self, rows: DataFrame, table: str) -> None:
        (rows.repartition(self.buckets, "digest").write.format("parquet").mode("append")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(table))

    def compact(self) -> None:
        """One file a bucket, in a new folder."""
        rows, old = self.read(), self.layout
        number = int(old["folder"].rpartition("-")[2]) + 1
        fresh = DigestIndex.__new__(DigestIndex)
        fresh.spark, fresh.path, fresh.buckets, fresh.name = self.spark, self.path, self.buckets, f"{self.name}_next"
        fresh.layout = {"folder": f"files-{number}"}
        textfile.delete(self.spark, self.path, fresh.layout["folder"])       # of a compaction that failed
        fresh._open()
        fresh._append(rows, fresh.name)
        fresh.close()
        self._commit(folder=fresh.layout["folder"], files=1, before=old["folder"])
        self._open()
        if old["before"]:
            textfile.delete(self.spark, self.path, old["before"])


def dedup(docs: DataFrame, batches: int = 2) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The documents go into a new index in ``batches`` ranges of doc_id, the
    largest ids first, so that what the index has first is what stays.
    """
    rows = stage(digests(docs), "digests")
    lo, hi = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    index = DigestIndex(docs.sparkSession)
    place = F.lit(0) if lo is None else F.coalesce(
        F.least(F.floor((F.lit(float(hi)) - F.col("doc_id")) / (float(hi) - lo + 1) * batches),
                F.lit(batches - 1)), F.lit(batches - 1))
    for k in range(batches):
        index.add(rows.where(place == k))
    sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = stage(index.read().join(sizes, "digest"), "digest-groups")
    index.close()
    return join_groups(rows, groups, ["digest"], "group_size").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
       sha256(t.body) AS text_sha256
FROM t JOIN g ON t.body = g.body
"""
