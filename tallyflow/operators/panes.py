"""Sliding windows by panes (T2, T5 with A5-A8).

A pane is a tumbling window of gcd(length, slide): every sliding window, and
every stretch by which it moves on, is made of whole panes. Rows are counted
once per pane and key; only the counts are then given to the windows they
belong to and summed up. No row is copied before the first aggregate, however
many windows overlap.

An *activation* is a window that ends (every ``slide``). A pane is, for an
activation with window [start, start + length):

* ``all``     in the window;
* ``new``     in the window and not in the one before;
* ``expired`` in the window before and no longer in this one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "all"
NEW = "new"
EXPIRED = "expired"


def _interval(n: int) -> Column:
    return F.expr(f"INTERVAL '{n}' SECOND")


def pane(time_col: str, length: int, slide: int) -> Column:
    """The pane of a row, to group by (name it ``_p``); seconds."""
    return F.window(time_col, f"{math.gcd(length, slide)} seconds")


def to_windows(panes: DataFrame, length: int, slide: int, expired: bool = False) -> DataFrame:
    """``panes`` (column ``_p`` and others) copied to the windows ``_w`` they
    play a part in, with the flags ``_all``, ``_new`` and ``_expired`` (rows that
    only expire come only if asked for)."""
    at = F.col("_p.start")
    last = F.col("_s.start")
    # the first start is the activation at which a pane of the window before may have gone
    steps = range(-1 if expired else 0, -(-length // slide))
    starts = [last - _interval(k * slide) if k >= 0 else last + _interval(slide) for k in steps]
    spans = F.array(*[F.struct(s.alias("start"), (s + _interval(length)).alias("end")) for s in starts])
    others = [c for c in panes.columns if c != "_p"]
    start, end = F.col("_w.start"), F.col("_w.end")
    inside = (at >= start) & (at < end)
    before = (at >= start - _interval(slide)) & (at < end - _interval(slide))
    out = (panes.select("_p", F.window(at, f"{slide} seconds").alias("_s"), *others)
           .select("_p", F.explode(spans).alias("_w"), *others)
           .withColumns({"_all": inside, "_new": inside & ~before, "_expired": before & ~inside}))
    return out.where(F.col("_all") | F.col("_expired")) if expired else out.where("_all")


def window_changes(df: DataFrame, keys: list[str] | tuple[str, ...] = (), time_col: str = "event_time",
                   length: int = 3600, slide: int = 900) -> DataFrame:
    """T5: per activation and key the rows of the window (``n_all``), those that
    came (``n_new``) and those that left (``n_expired``) since the activation
    before; ``length`` and ``slide`` in seconds.

    A key whose last rows leave has one activation with ``n_all`` 0. For every
    key ``n_all`` = that of the activation before + ``n_new`` - ``n_expired``.
    Null keys form their own group; rows without a time are in no window.
    """
    panes = (df.where(F.col(time_col).isNotNull()).groupBy(pane(time_col, length, slide).alias("_p"), *keys)
             .agg(F.count(F.lit(1)).alias("_n")))
    n = F.col("_n")
    agg = to_windows(panes, length, slide, expired=True).groupBy("_w", *keys).agg(
        *[F.coalesce(F.sum(F.when(F.col(f"_{role}"), n)), F.lit(0)).alias(f"n_{role}") for role in (ALL, NEW, EXPIRED)])
    return agg.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys,
                      "n_all", "n_new", "n_expired")
