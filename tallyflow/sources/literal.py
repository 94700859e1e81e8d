"""Literal rows as a DataFrame (the reference's fixed-batch source).

The reference cycles its literal rows forever; here they are a plain batch
(streams are fed from files instead).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyflow import schemas


def literal_rows(spark: SparkSession, schema, rows: Iterable[Sequence]) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def request_strings(spark: SparkSession, args: Iterable[str]) -> DataFrame:
    """S4 in batch form: ``(request_id, args)`` with ids 0..n-1."""
    return spark.createDataFrame([(i, a) for i, a in enumerate(args)], schemas.REQUESTS)
