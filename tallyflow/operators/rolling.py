"""Rolling top-N by a sketch of fixed size (O1 with T2).

A pane's sketch is ``counters`` numbers: keys are hashed to slots, and a slot
counts the rows of all its keys. Sketches are merged by adding them up: those of
a window's panes give the window's. A slot's count is at least that of any of
its keys, so the top ``n`` of a window are found exactly in two steps:

1. the keys of the window's ``n`` largest slots are counted exactly; the n-th
   largest of these counts is ``least`` (0 if there are fewer than ``n`` keys).
   The n-th largest count of all keys is at least that;
2. a key of the top ``n``, ties included, has ``least`` rows or more, so its slot
   has too: only the keys of such slots are counted exactly, and only those
   that reach ``least`` are ranked.

Whatever the number of keys, a pane puts at most ``counters`` rows in the
first exchange, and about ``n`` rows a window come to the ranking, for any
``n`` (no limit of Spark's is needed). Keys without a clear top (all counts
alike) are counted nearly all: nothing is dropped to save work.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.operators.panes import pane, to_windows
from tallyflow.session import sub_dir

COUNTERS = 1 << 14
# More slots than this are not broadcast: keys are then counted before the join.
BROADCAST_SLOTS = 1 << 18


def _staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: read more than once, made once."""
    path = sub_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pane_rows(df: DataFrame, key_col: str, time_col: str, length: int, slide: int, counters: int) -> DataFrame:
    """The rows as pane, slot and key; rows without a time are in no window."""
    slot = F.pmod(F.xxhash64(key_col), F.lit(counters)).cast("int")
    return df.where(F.col(time_col).isNotNull()).select(
        pane(time_col, length, slide).alias("_p"), slot.alias("_slot"), F.col(key_col).alias("_k"))


def sketch(rows: DataFrame) -> DataFrame:
    """The slots' counts by pane."""
    return rows.groupBy("_p", "_slot").agg(F.count(F.lit(1)).alias("_n"))


def merged(panes: DataFrame, length: int, slide: int) -> DataFrame:
    """The slots' counts by window: no key of a slot has more rows."""
    return to_windows(panes, length, slide).groupBy("_w", "_slot").agg(F.sum("_n").alias("_most"))


def count_slots(rows: DataFrame, panes: DataFrame, slots: DataFrame, length: int, slide: int) -> DataFrame:
    """Exact counts by window and key of the keys in ``slots`` (``_w``, ``_slot``)."""
    by = ["_w", "_slot"]
    need = _staged(to_windows(panes.select("_p", "_slot"), length, slide).join(slots, by, "left_semi")
                   .select("_p", "_slot").distinct(), "topn-need")
    if need.count() <= BROADCAST_SLOTS:
        counts = rows.join(F.broadcast(need), ["_p", "_slot"], "left_semi")
        counts = counts.groupBy("_p", "_slot", "_k").agg(F.count(F.lit(1)).alias("_n"))
    else:
        counts = rows.groupBy("_p", "_slot", "_k").agg(F.count(F.lit(1)).alias("_n"))
        counts = counts.join(need, ["_p", "_slot"], "left_semi")
    # a pane's slot may be needed by one of its windows only
    return (to_windows(counts, length, slide).join(slots, by, "left_semi")
            .groupBy("_w", "_k").agg(F.sum("_n").alias("_n")))


def rolling_top_n(df: DataFrame, n: int, key_col: str = "key", time_col: str = "event_time", length: int = 3600,
                  slide: int = 900, counters: int = COUNTERS) -> DataFrame:
    """O1: per window of ``length`` seconds every ``slide`` seconds the ``n``
    keys with the most rows (``n``, ``rank``), ties by key ascending. Null keys
    form their own group."""
    rows = pane_rows(df, key_col, time_col, length, slide, counters)
    panes = _staged(sketch(rows), "topn-panes")
    seen = _staged(merged(panes, length, slide), "topn-windows")
    large = Window.partitionBy("_w").orderBy(F.desc("_most"), "_slot")
    first = seen.withColumn("_r", F.row_number().over(large)).where(F.col("_r") <= n).select("_w", "_slot")
    ranks = F.row_number().over(Window.partitionBy("_w").orderBy(F.desc("_n"), F.asc("_k"))).cast("long")
    leaders = count_slots(rows, panes, first, length, slide).withColumn("_r", ranks).where(F.col("_r") <= n)
    least = _staged(leaders.groupBy("_w").agg(
        F.when(F.count(F.lit(1)) >= n, F.min("_n")).otherwise(0).alias("_least")), "topn-least")
    slots = seen.join(least, "_w").where("_most >= _least").select("_w", "_slot")
    top = (count_slots(rows, panes, slots, length, slide).join(least, "_w").where("_n >= _least")
           .withColumn("rank", ranks).where(F.col("rank") <= n))
    return top.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      F.col("_k").alias(key_col), F.col("_n").alias("n"), "rank")
