"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# A word of the contracts: a run of characters other than space and \t..\r.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (any path Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    Cuts the lineage: a lost executor costs no recomputation beyond the table.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def wrapped(docs: DataFrame, **named: Column) -> DataFrame:
    """``docs`` as one column ``_row`` and the ``named`` columns computed from
    it: whatever the table's own columns are called, they clash with none of
    an operator's. ``select("_row.*")`` gives the table again."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       *[c.alias(k) for k, c in named.items()])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Send whole texts to Python in small Arrow batches.

    Batches are counted in rows, and texts can be long: Spark's 10,000 rows of
    text a batch would cost each Python worker several copies of them.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def word_count(col: Column) -> Column:
    """Number of words (``WORD``) of a text; null counts as empty."""
    return F.regexp_count(F.coalesce(col, F.lit("")), F.lit(WORD)).cast("long")


def crc32_sql(text: str) -> str:
    """The CRC-32 of a text in DuckDB's SQL, bit by bit: each byte is put in, then shifted out eight times."""
    byte = f"('0x' || substr(hex(encode({text})), (2 * i + 1)::INTEGER, 2))::BIGINT"
    steps = f"flatten(list_transform(range(octet_length(encode({text}))), lambda i: [{byte}, {', '.join(['-1'] * 8)}]))"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) "
            "WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)")


# A group of more than this share of all rows is joined by broadcast: there
# are at most HEAVY such groups, whatever the table's size.
HEAVY = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows`` joined with one row per group (inner, on ``keys``).

    ``size`` holds the group's number of rows. Groups of more than one row in
    ``HEAVY`` are fewer than ``HEAVY``, so their group rows are broadcast and
    their members stay where they are; the other groups meet by key, none of
    them larger than that share.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    heavy = F.broadcast(groups.where(F.col(size) > total / HEAVY))
    light = groups.where(F.col(size) <= total / HEAVY)
    few = F.broadcast(groups.where(F.col(size) > total / HEAVY).select(*keys))
    return (rows.join(heavy, keys)
            .unionByName(rows.join(few, keys, "left_anti").join(light, keys)))
