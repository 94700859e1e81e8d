"""Streaming keyed state (IDs A4, S5, T6, T7, T11).

* ``LatestWithTTL``: per-key latest value kept in the state store with a
  processing-time TTL (the hash store's 300 s expiry), via
  ``transformWithStateInPandas``. Each input batch is reduced per key inside
  the grouped call; only the key's latest row is kept. Needs the RocksDB
  state store provider (set in ``tallyflow.session.DEFAULT_CONF``).
* ``read_changes``: the changes of a query's state, from the state store's
  change feed, with the value before and after (T11).
* ``read_state``: a finished or running query's state as a batch DataFrame
  (S5, the readable state handle).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Fixed value (as in tallyflow.operators.state): hash-store expiry, seconds.
DEFAULT_TTL_SECONDS = 300

LATEST_STATE = T.StructType([
    T.StructField("n", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])


def latest_output_schema(key: str) -> T.StructType:
    return T.StructType([
        T.StructField(key, T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("updated_at", T.TimestampType()),
    ])


class LatestWithTTL(StatefulProcessor):
    """A4 + T6: keep the latest ``n`` per key; expire it ``ttl_seconds``
    after its last write (processing time). Rows without an order time are
    left out; a null value is kept as null. A row that is not older than the
    stored one is a write: it replaces the value and starts the TTL again.
    Older rows change nothing. The key's value is emitted when a write has
    changed it (update stream, T11)."""

    def __init__(self, key: str, value_col: str = "n", order_col: str = "updated_at",
                 ttl_seconds: int = DEFAULT_TTL_SECONDS):
        self.key, self.value_col, self.order_col = key, value_col, order_col
        self.ttl_ms = int(ttl_seconds) * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("latest", LATEST_STATE, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        old = self.state.get() if self.state.exists() else None
        best = old
        for pdf in rows:
            pdf = pdf[pdf[self.order_col].notna()]
            if pdf.empty:
                continue
            # of equal times the greatest value, so no order of arrival matters
            i = pdf.sort_values([self.order_col, self.value_col], na_position="first").index[-1]
            n, t = pdf.at[i, self.value_col], pdf.at[i, self.order_col]
            if best is None or t >= best[1]:
                best = (None if pd.isna(n) else int(n), t)
        if best is not old:
            self.state.update(best)
            if old is None or tuple(best) != tuple(old):
                yield pd.DataFrame({self.key: [key[0]], "n": pd.array([best[0]], dtype="Int64"),
                                    "updated_at": [best[1]]})

    def close(self) -> None:
        pass


# A task of the first level holds this many keys at most, then hands them on.
PARTIAL_KEYS = 100_000


def partial_latest(df: DataFrame, key: str, value_col: str = "n", order_col: str = "updated_at",
                   salts: int | None = None) -> DataFrame:
    """Rows ``(key, value, order)`` with each task's latest row per key only (of
    equal times the greatest value); rows without an order time are left out.

    Stateless, so it runs before the stateful operator of a stream: of a key with
    a third of all rows one row per task is shuffled to its state. The rows of a
    key that lies in one piece of the source (a keyed topic) are first spread
    over ``salts`` tasks by a hash of the row.
    """
    cols, schema = [key, value_col, order_col], df.select(key, value_col, order_col).schema
    rows = df.select(*cols).where(F.col(order_col).isNotNull())
    if salts:
        rows = rows.repartition(salts, key, F.pmod(F.xxhash64(*cols), F.lit(salts)))

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for b in batches:
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            held = (b.sort_values([order_col, value_col], na_position="first", kind="stable")
                    .drop_duplicates(key, keep="last"))
            if len(held) >= PARTIAL_KEYS:
                yield held
                held = None
        if held is not None:
            yield held

    return rows.mapInPandas(reduce, schema)


def latest_with_ttl_stream(df: DataFrame, key: str, value_col: str = "n",
                           order_col: str = "updated_at",
                           ttl_seconds: int = DEFAULT_TTL_SECONDS, salts: int | None = None) -> DataFrame:
    """Apply ``LatestWithTTL`` to a stream of ``(key, value, order)`` rows.

    In two levels: ``partial_latest`` (with ``salts``) per task, then the state
    of each key. Spark rejects a windowed append-mode count feeding this operator in the
    same query (global-watermark correctness check), so such counts come
    from another query's output (files or a topic); the rolling job instead
    upserts its closed windows into a TTL snapshot.
    """
    staged = df.select(df[key].cast("string").alias(key), df[value_col].cast("long").alias(value_col),
                       df[order_col].cast("timestamp").alias(order_col))
    staged = partial_latest(staged, key, value_col, order_col, salts)
    return staged.groupBy(key).transformWithStateInPandas(
        statefulProcessor=LatestWithTTL(key, value_col, order_col, ttl_seconds),
        outputStructType=latest_output_schema(key),
        outputMode="Update", timeMode="ProcessingTime")


# Ship the processor to Python workers by value, so workers need not have
# this package installed (it is still shipped with --py-files on clusters).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_state(spark: SparkSession, checkpoint: str, operator_id: int | None = None,
               store_name: str | None = None) -> DataFrame:
    """The state of a streaming query as a batch DataFrame."""
    r = spark.read.format("statestore")
    if operator_id is not None:
        r = r.option("operatorId", operator_id)
    if store_name is not None:
        r = r.option("storeName", store_name)
    return r.load(checkpoint)


# A change feed needs the changes of each micro-batch in the checkpoint.
CHANGE_FEED_CONF = {"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def read_changes(spark: SparkSession, checkpoint: str, start: int = 0, end: int | None = None,
                 operator_id: int = 0) -> DataFrame:
    """What the micro-batches ``start`` to ``end`` (default: the last)
    changed in a query's state: batch_id, key, before and after (structs; a key
    that a batch made has no ``before``, one that it removed no ``after``).

    Start the query under ``CHANGE_FEED_CONF``. A key changes once a micro-batch
    at most, so the window over a key's changes is as long as the batches asked
    for; the state before ``start`` is read once if there is one.
    """
    r = (spark.read.format("statestore").option("readChangeFeed", True).option("operatorId", operator_id)
         .option("changeStartBatchId", start))
    if end is not None:
        r = r.option("changeEndBatchId", end)
    rows = r.load(checkpoint).select("batch_id", "key", F.when(F.col("change_type") == "update", F.col("value")).alias("after"))
    if start > 0:
        base = (spark.read.format("statestore").option("operatorId", operator_id).option("batchId", start - 1)
                .load(checkpoint))
        rows = rows.unionByName(base.select(F.lit(start - 1).cast("long").alias("batch_id"), "key", F.col("value").alias("after")))
    before = F.lag("after").over(Window.partitionBy("key").orderBy("batch_id"))
    return rows.select("batch_id", "key", before.alias("before"), "after").where(F.col("batch_id") >= start)
