"""Keyed state in batch form (IDs A1-A4, K2/K3 mapping, T6, T7, C14).

The reference keeps ``key -> count`` in process memory or a hash store. In
Spark the state of a batch job is a DataFrame (one row per key, written as a
snapshot table by ``tallyflow.sinks.snapshot``); the stream forms keep it in
the checkpointed state store (``tallyflow.streaming``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.functions.jsonfields import as_text

# Fixed value: state expiry of the rolling job's hash store, in seconds.
DEFAULT_TTL_SECONDS = 300

KEY = "key"
TABLE = "table"


def running_count(df: DataFrame, key: str = "word", out: str = "count") -> DataFrame:
    """Number of rows per key (stream: complete or update mode)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def latest_per_key(df: DataFrame, key: str, value: str = "n",
                   order_col: str = "window_end", out_value: str | None = None,
                   out_time: str = "updated_at") -> DataFrame:
    """A4: the latest value per key (``combine(a, b) = b``), latest meaning
    greatest ``order_col``; ``updated_at`` is that order value.

    ``max_by`` is a mergeable aggregate: partial per map task, final after
    one exchange; a key with a third of all rows costs one partial row per
    task.
    """
    out_value = out_value or value
    return df.groupBy(key).agg(F.max_by(value, order_col).alias(out_value),
                               F.max(order_col).alias(out_time))


def live_state(state: DataFrame, updated_col: str = "updated_at",
               ttl_seconds: int = DEFAULT_TTL_SECONDS,
               as_of: Column | None = None, scope: str = KEY,
               writes: DataFrame | None = None) -> DataFrame:
    """Drop state that has expired ``as_of`` (default: now).

    ``scope="key"``: a key lives while ``updated_at > as_of - ttl``.
    ``scope="table"``: the whole table expires together when nothing is
    written for longer than the TTL, and every write starts the time again (how
    a hash store expires a whole hash): the keys written since the last pause
    longer than the TTL live, if the last write is within the TTL. ``writes``
    holds the times of all writes in ``updated_col`` (default: ``state``, which
    knows each key's last write only).
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    cutoff = as_of - F.expr(f"INTERVAL '{int(ttl_seconds)}' SECOND")
    if scope == KEY:
        return state.where(F.col(updated_col) > cutoff)
    if scope == TABLE:
        life = _current_life(writes if writes is not None else state, updated_col, ttl_seconds, as_of)
        return (state.join(F.broadcast(life), (F.col(updated_col) >= F.col("_since")) & (F.col("_last") > cutoff))
                .select(*state.columns))
    raise ValueError(f"scope must be {KEY!r} or {TABLE!r}")


def _current_life(writes: DataFrame, col: str, ttl_seconds: int, as_of: Column) -> DataFrame:
    """One row: ``_last``, the last write by ``as_of``, and ``_since``, the
    first write after the last pause longer than the TTL.

    Writes are reduced to their first and last time per TTL-long bucket; no
    pause within a bucket is longer than the TTL. Only the buckets (at most one
    per TTL of the covered time) are looked at in order.
    """
    t = F.col(col)
    micros = F.unix_micros(t.cast("timestamp"))
    buckets = (writes.where(t <= as_of)
               .groupBy(F.floor(micros / (int(ttl_seconds) * 1_000_000)).alias("_b"))
               .agg(F.min(t).alias("_first"), F.max(t).alias("_end")))
    before = F.lag("_end").over(Window.orderBy("_b"))
    fresh = before.isNull() | (F.col("_first") > before + F.expr(f"INTERVAL '{int(ttl_seconds)}' SECOND"))
    return (buckets.withColumn("_fresh", F.when(fresh, F.col("_first")))
            .agg(F.max("_fresh").alias("_since"), F.max("_end").alias("_last")))


def store_records(state: DataFrame, key: str, value: str,
                  key_out: str = "key", value_out: str = "value") -> DataFrame:
    """K2 / P10 / C14 mapper: ``(key, value as text)`` hash-store entries."""
    return state.select(F.col(key).cast("string").alias(key_out),
                        as_text(F.col(value)).alias(value_out))
