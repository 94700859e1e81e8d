"""Look-ups as of the request's time (J1-J3 on a timed state).

Each request is answered with the state its key had at the request's time: the
latest history row of the key that is not later. Requests and history are laid
out together by a range partitioning on (key, time), so a key with a third of
all rows is spread over a third of the partitions. Within a partition a window
function fills in the latest history row. What a partition hands on to the next
ones is one row: its greatest history row. Those rows, at most one per
partition, are broadcast.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.session import sub_dir


def as_of(requests: DataFrame, history: DataFrame, key_col: str = "key", time_col: str = "event_time",
          value_cols: tuple[str, ...] = ("n",), state_time: str = "updated_at") -> DataFrame:
    """``requests`` with the ``value_cols`` and ``state_time`` of the latest row
    of ``history`` that has their ``key_col`` and a ``time_col`` not after theirs
    (null without one). Both tables have ``key_col`` and ``time_col``.

    Of history rows with equal key and time the one with the greatest values
    counts. Null keys and times match nothing and count nothing. Repeated
    requests are each answered. The laid-out rows are written under the shared
    checkpoint folder, so the plan reads them once from there.
    """
    spark = requests.sparkSession
    key, time = F.col(key_col).alias("_k"), F.col(time_col).alias("_t")
    value = F.struct(*value_cols).alias("_v")
    asked = F.struct(*requests.columns).alias("_r")
    none = lambda df, col, name: F.lit(None).cast(df.select(col).schema[0].dataType).alias(name)
    known = history.where(F.col(key_col).isNotNull() & F.col(time_col).isNotNull())
    rows = (known.select(key, time, F.lit(0).alias("_kind"), value, none(requests, asked, "_r"))
            .unionByName(requests.select(key, time, F.lit(1).alias("_kind"), none(history, value, "_v"), asked)))
    path = sub_dir(spark, f"as-of-{uuid.uuid4().hex}")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.repartitionByRange(parts, "_k", "_t", "_kind").withColumn("_part", F.spark_partition_id())
     .write.parquet(path))
    placed = spark.read.parquet(path)

    entry = F.struct(F.col("_t").alias("t"), F.col("_v").alias("v"))
    within = Window.partitionBy("_part", "_k").orderBy("_t", "_kind", "_v")
    filled = placed.withColumn("_own", F.last(F.when(F.col("_kind") == 0, entry), ignorenulls=True).over(
        within.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("_kind = 1")

    top = F.max(F.struct("_k", F.col("_t").alias("t"), F.col("_v").alias("v")))
    tops = (placed.where("_kind = 0").groupBy("_part").agg(top.alias("_top"))       # one row per partition
            .select(F.col("_top._k").alias("_k"), F.struct("_top.t", "_top.v").alias("_carry"), F.col("_part").alias("_from")))
    until = F.lead("_from").over(Window.partitionBy("_k").orderBy("_from"))
    tops = tops.withColumn("_until", F.coalesce(until, F.lit(parts)))
    out = filled.join(F.broadcast(tops), (filled["_k"] == tops["_k"]) & (F.col("_part") > F.col("_from"))
                      & (F.col("_part") <= F.col("_until")), "left")
    found = F.when(F.col("_t").isNotNull(), F.coalesce("_own", "_carry"))
    kept = [c for c in requests.columns if c not in (*value_cols, state_time)]
    return out.select(*[F.col(f"_r.`{c}`") for c in kept], found.alias("_found")).select(
        *kept, *[F.col(f"_found.v.{c}").alias(c) for c in value_cols], F.col("_found.t").alias(state_time))
