"""The registered ``opN_<name>`` queries: each applies its operator, with
production parameters, to its whole table and returns the full result.

``ENTRIES`` maps a name to the query and its DuckDB SQL (None where SQL cannot
express the operator; ``tests/llm/`` holds the brute-force check instead).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm import (decontam, exact_index, licenses, line_windows, merkle, mixing, partenum,
                           pseudonyms, quality, spelling, token_files, url_trie, warc)
from tallyflow.llm.common import read_table, scratch


# The queries' key; a real one comes from the caller's secret store.
KEY = b"tallyflow example key"


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-files")
    token_files.write(read_table(spark, sf_dir, "documents"), path,
                      public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_digests(spark, path)


def op2_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.join(read_table(spark, sf_dir, "documents"), words=4, percent=85)


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_runs(read_table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write(read_table(spark, sf_dir, "pages"), path, min_bytes=0)
    return warc.read(spark, path).where("gap_bytes is null").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_exact_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_index.dedup(read_table(spark, sf_dir, "documents"))


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pseudonyms.pseudonymise(docs, KEY)
    n = F.aggregate(F.map_values("pii"), F.lit(0), lambda a, b: a + b)
    return out.select("doc_id", "text", n.alias("n_pii"))


def op8_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_windows.dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return docs.withColumn("score", quality.probability(docs, weights)).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op10_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decisions(read_table(spark, sf_dir, "documents"))


def op11_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_trie.RULE_ROWS, url_trie.RULES)
    return url_trie.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return merkle.verify(docs, merkle.tampered(docs))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(spelling.vocabulary(read_table(spark, sf_dir, "documents")))


ENTRIES = {
    "op1_token_files": (op1_token_files, None),
    "op2_partenum": (op2_partenum, None),
    "op3_decontam": (op3_decontam, None),
    "op4_licenses": (op4_licenses, licenses.ORACLE),
    "op5_warc": (op5_warc, warc.ORACLE),
    "op6_exact_index": (op6_exact_index, exact_index.ORACLE),
    "op7_pseudonyms": (op7_pseudonyms, None),
    "op8_line_windows": (op8_line_windows, line_windows.ORACLE),
    "op9_quality": (op9_quality, None),
    "op10_budget_mix": (op10_budget_mix, None),
    "op11_url_trie": (op11_url_trie, url_trie.ORACLE),
    "op12_merkle": (op12_merkle, merkle.ORACLE),
    "op13_spelling": (op13_spelling, spelling.ORACLE),
}
