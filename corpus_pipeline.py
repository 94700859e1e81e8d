"""From raw documents to token files, in five stages.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all that the
stage before kept, written as Parquet and read again. All but the last return
the columns of ``documents``. ``run`` applies them to the documents table.

1. quality: a classifier learned from ``labels`` scores every text; documents
   under the threshold go.
2. near_duplicates: documents whose sets of five-word shingles link at a
   similarity of 0.8 form groups; the one with the smallest doc_id of each
   group stays. Documents without words are in no group and stay.
3. decontaminate: documents that hold a benchmark item go.
4. mix: sources are mixed to their target weights. A document taken k times
   comes k times, one not taken goes; documents of size 0 stay.
5. token_files: the texts become token files; the stage returns their digest
   as read back from the files.

Texts that are null count as empty in every stage. Rows that repeat a doc_id
and its text are copies to stage 2, which keeps one of each group of copies.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyflow.llm import decontam, mixing, partenum, quality, token_files
from tallyflow.llm.common import read_table, scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return partenum.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-files")
    token_files.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_digests(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
    ("token_files", token_stage),
]

# No SQL says what a classifier learns, which component PartEnum's links form
# or what a tokenizer gives: the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
