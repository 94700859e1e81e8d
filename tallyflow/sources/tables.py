"""Loading the parquet tables the queries read.

Plain ``spark.read.parquet`` with the explicit schemas of
``tallyflow.schemas.TABLE_SCHEMAS`` (no inference job): Catalyst prunes to the
referenced columns (``ReadSchema``) and pushes filters into the scan, so
loaders select nothing themselves.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tallyflow.schemas import TABLE_SCHEMAS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    path = os.path.join(sf_dir, f"{name}.parquet")
    if name in TABLE_SCHEMAS:
        return spark.read.schema(TABLE_SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


INPUT_PARTITIONS = "spark.tallyflow.inputPartitions"


def spread(df: DataFrame, *key_cols: str) -> DataFrame:
    """Repartition an input by ``key_cols`` into the number of partitions that
    the session's ``spark.tallyflow.inputPartitions`` names; unset (the
    default), the input stays as it is.

    For tables of a few files with one row group each, which one task reads
    however many splits Spark makes: the setting buys parallel per-row work
    for one shuffle of the raw rows. Inputs of many files need none.
    """
    n = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(n), *key_cols) if n else df
