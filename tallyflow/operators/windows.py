"""Windowed counts (IDs A5-A13, T1, T2, T5, F5, F6, U1).

All windows are event-time windows from ``F.window`` (tumbling when
``slide`` is None, sliding otherwise), aligned to the epoch. Each count is
one hash aggregate with a map-side partial step: a hot key or a hot window is
collapsed per map task before the exchange.

``rows`` selects which rows of a window are counted (T5): ``"all"`` counts
every row of ``[start, start + length)``; ``"new"`` counts only the rows that
arrived since the previous activation, i.e. ``[end - slide, end)``. With
``slide == length`` (the reference's 10 s / 10 s) both are the same.

Functions that end in a plain aggregate also run on streaming DataFrames
(add ``withWatermark`` upstream). ``hierarchical_count`` joins the window's
first time back to its groups; on a stream the groups (``window_groups``) are
aggregated by the stream and ``with_first_time`` runs on the closed windows of
each micro-batch (``tallyflow.streaming.forms``).

Sliding windows of a batch are made of panes (``tallyflow.operators.panes``):
rows are counted once per pane, and the counts are summed up per window. Streams
use Spark's own sliding windows, which state and watermark need.

The slide need not divide the length. Sliding windows start at multiples of the
slide, so they end at multiples of the slide plus ``length mod slide``; the
buckets of new rows are shifted by that much, and each ends with its window.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.operators.panes import ALL, NEW, pane, to_windows

# Result codes counted by the conditional roll-up.
RESULT_CODE_METRICS = {
    "login_success": "10000",
    "register_success": "10002",
}

# Labels of the per-name count maps.
NAME_LABELS = ("project_name", "class_name", "method_name")


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(length: str) -> int:
    """``'10 seconds'`` / ``'1 hour'`` -> its number of seconds."""
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", length, re.I)
    if not m:
        raise ValueError(f"unsupported window length {length!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def interval(length: str) -> Column:
    """The same as a day-time interval literal."""
    return F.expr(f"INTERVAL '{seconds(length)}' SECOND")


def _new_rows(length: str, slide: str | None, rows: str) -> bool:
    if rows not in (ALL, NEW):
        raise ValueError(f"rows must be {ALL!r} or {NEW!r}")
    return rows == NEW and slide is not None and seconds(slide) != seconds(length)


def _slides(df: DataFrame, length: str, slide: str | None) -> bool:
    """Whether windows of a batch overlap or leave gaps, so that panes serve."""
    return not df.isStreaming and slide is not None and seconds(slide) != seconds(length)


def _pane(time_col: str, length: str, slide: str) -> Column:
    return pane(time_col, seconds(length), seconds(slide)).alias("_p")


def _windows_of(panes: DataFrame, length: str, slide: str) -> DataFrame:
    return to_windows(panes, seconds(length), seconds(slide))


def window_col(time_col: str, length: str, slide: str | None = None,
               rows: str = ALL) -> Column:
    """The window a row is grouped by: the (sliding) window itself, or for
    ``rows="new"`` the tumbling ``slide`` bucket that is the window's last
    ``slide`` (each row falls in exactly one). Both are real window columns,
    so streams can aggregate them in append mode; ``window_bounds`` turns the
    group into the output window."""
    if _new_rows(length, slide, rows):
        return F.window(time_col, slide, slide, f"{seconds(length) % seconds(slide)} seconds")
    return F.window(time_col, length, slide) if slide else F.window(time_col, length)


def window_bounds(length: str, slide: str | None = None, rows: str = ALL,
                  w: str = "_w") -> list[Column]:
    """``window_start, window_end`` of a group made by ``window_col``."""
    if _new_rows(length, slide, rows):
        return [(F.col(f"{w}.end") - interval(length)).alias("window_start"),
                F.col(f"{w}.end").alias("window_end")]
    return [F.col(f"{w}.start").alias("window_start"), F.col(f"{w}.end").alias("window_end")]


def window_count(df: DataFrame, keys: list[str] | tuple[str, ...] = (),
                 time_col: str = "event_time", length: str = "10 seconds",
                 slide: str | None = None, rows: str = ALL,
                 count_col: str = "n") -> DataFrame:
    """Rows per key per window.

    ``keys=()`` gives the window total (A9). Null keys form their own group
    (Q9). Output: ``window_start, window_end, *keys, <count_col>``.
    """
    if rows == ALL and _slides(df, length, slide):
        panes = df.groupBy(_pane(time_col, length, slide), *keys).agg(F.count(F.lit(1)).alias("_n"))
        counted = _windows_of(panes, length, slide).groupBy("_w", *keys).agg(F.sum("_n").alias(count_col))
    else:
        staged = df.select(window_col(time_col, length, slide, rows).alias("_w"), *keys)
        counted = staged.groupBy("_w", *keys).agg(F.count(F.lit(1)).alias(count_col))
    return counted.select(*window_bounds(length, slide, rows), *keys, count_col)


def window_total(df: DataFrame, time_col: str = "event_time",
                 length: str = "10 seconds", slide: str | None = None,
                 rows: str = ALL, count_col: str = "n") -> DataFrame:
    """Total rows per window."""
    return window_count(df, (), time_col, length, slide, rows, count_col)


def counts_by_name(df: DataFrame, names: dict[str, str] | None = None,
                   time_col: str = "event_time", length: str = "10 seconds",
                   slide: str | None = None, rows: str = ALL,
                   count_col: str = "n") -> DataFrame:
    """A5 fused + U1: per-window counts by several single keys in one pass.

    ``names`` maps an output label to a key column (default: project, class
    and method names). One ``GROUPING SETS`` aggregate — one exchange —
    replaces one aggregate per key plus a union. Output:
    ``window_start, window_end, name, key, <count_col>``.
    """
    names = names or {n: n for n in NAME_LABELS}
    labels, cols = list(names), list(names.values())
    paned = rows == ALL and _slides(df, length, slide)
    span = _pane(time_col, length, slide) if paned else window_col(time_col, length, slide, rows).alias("_w")
    staged = df.select(span, *[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)])
    ks, gs = [f"_k{i}" for i in range(len(cols))], [f"_g{i}" for i in range(len(cols))]
    w = "_p" if paned else "_w"
    agg = staged.groupingSets([[w, k] for k in ks], w, *ks).agg(
        F.count(F.lit(1)).alias(count_col), *[F.grouping(k).alias(g) for k, g in zip(ks, gs)])
    if paned:
        agg = _windows_of(agg, length, slide).groupBy("_w", *ks, *gs).agg(F.sum(count_col).alias(count_col))
    name = F.lit(None).cast("string")
    key = F.lit(None).cast("string")
    for i in reversed(range(len(ks))):
        name = F.when(F.col(f"_g{i}") == 0, F.lit(labels[i])).otherwise(name)
        key = F.when(F.col(f"_g{i}") == 0, F.col(ks[i]).cast("string")).otherwise(key)
    return agg.select(*window_bounds(length, slide, rows), name.alias("name"), key.alias("key"),
                      count_col)


def _new_in_window(length: str, slide: str | None, rows: str) -> Column:
    """Whether a row at ``_t`` is new in its sliding window ``_w``."""
    if _new_rows(length, slide, rows):
        return F.col("_t") >= F.col("_w.end") - interval(slide)
    return F.lit(True)


def window_groups(df: DataFrame, time_col: str = "event_time", length: str = "10 seconds",
                  slide: str | None = None, rows: str = ALL,
                  keys: tuple[str, ...] = NAME_LABELS) -> DataFrame:
    """One row per window and key: ``total_count`` and the group's least time
    ``_first`` over all rows of the window. With ``rows="new"`` the count is
    that of the new rows (0 for a group without any); the input is read once.
    Runs on streams (append mode: a window's groups come out together).
    """
    if _slides(df, length, slide):
        panes = df.groupBy(_pane(time_col, length, slide), *keys).agg(
            F.count(F.lit(1)).alias("_n"), F.min(time_col).alias("_first"))
        counted = F.when(F.col("_new"), F.col("_n")).otherwise(0) if rows == NEW else F.col("_n")
        agg = _windows_of(panes, length, slide).groupBy("_w", *keys).agg(
            F.sum(counted).alias("total_count"), F.min("_first").alias("_first"))
    else:
        staged = df.select(window_col(time_col, length, slide).alias("_w"), *keys, F.col(time_col).alias("_t"))
        agg = staged.groupBy("_w", *keys).agg(
            F.count(F.when(_new_in_window(length, slide, rows), F.lit(1))).alias("total_count"),
            F.min("_t").alias("_first"))
    return agg.select(*window_bounds(length, slide), *keys, "total_count", "_first")


def with_first_time(groups: DataFrame, keys: tuple[str, ...] = NAME_LABELS) -> DataFrame:
    """Stamp each group of ``window_groups`` with its window's first time
    and drop the groups without counted rows.

    The first time is a partial and final aggregate over the groups (one row
    per window), joined back; AQE broadcasts it or splits a large window.
    """
    # both branches read total_count and _first (which is never null; min over
    # a struct led by _first is min(_first)), so their exchange is the same and
    # is reused: the input is read and parsed once
    first = groups.groupBy("window_start", "window_end").agg(
        F.min(F.struct("_first", "total_count"))["_first"].alias("timestamp"))
    return (groups.where("total_count > 0 AND _first IS NOT NULL").join(first, ["window_start", "window_end"])
            .select("window_start", "window_end", *keys, "total_count", "timestamp"))


def hierarchical_count(df: DataFrame, time_col: str = "event_time",
                       length: str = "10 seconds", slide: str | None = None,
                       rows: str = ALL,
                       keys: tuple[str, str, str] = NAME_LABELS) -> DataFrame:
    """A7 + A8: count per (project, class, method) per window, each row
    stamped with the window's first message time (Q7: least event time)."""
    return with_first_time(window_groups(df, time_col, length, slide, rows, keys), keys)


def conditional_counts(df: DataFrame, code_col: str = "return_code",
                       time_col: str = "event_time", length: str = "10 seconds",
                       slide: str | None = None, rows: str = ALL,
                       metrics: dict[str, str] | None = None) -> DataFrame:
    """A6 + F5 + F6: per-window counts of rows whose code equals each
    metric's value, in tall form; zero counts are not emitted and a window
    with no match emits nothing. ``timestamp`` is the window's first time
    over all its rows. A null code matches nothing (Q10).

    Output: ``window_start, window_end, metric, n, timestamp``. One
    aggregate, also on streams, for ``"all"`` and ``"new"`` rows alike.
    """
    metrics = metrics or RESULT_CODE_METRICS
    if _slides(df, length, slide):
        panes = df.groupBy(_pane(time_col, length, slide)).agg(
            *[F.count_if(F.col(code_col) == F.lit(v)).alias(m) for m, v in metrics.items()],
            F.min(time_col).alias("_first"))
        counted = F.col("_new") if rows == NEW else F.col("_all")
        agg = _windows_of(panes, length, slide).groupBy("_w").agg(
            *[F.sum(F.when(counted, F.col(m)).otherwise(0)).alias(m) for m in metrics],
            F.min("_first").alias("timestamp"))
    else:
        staged = df.select(window_col(time_col, length, slide).alias("_w"),
                           F.col(code_col).alias("_code"), F.col(time_col).alias("_t"))
        new = _new_in_window(length, slide, rows)
        agg = staged.groupBy("_w").agg(
            *[F.count_if(new & (F.col("_code") == F.lit(v))).alias(m) for m, v in metrics.items()],
            F.min("_t").alias("timestamp"))
    wide = agg.select(*window_bounds(length, slide), "timestamp", *metrics)
    tall = wide.unpivot(["window_start", "window_end", "timestamp"], list(metrics), "metric", "n")
    return (tall.where(F.col("n") != 0)
            .select("window_start", "window_end", "metric", "n", "timestamp"))


def window_last_key(df: DataFrame, key: str, order_cols: tuple[str, ...] = ("ts_ms", "msg_id"),
                    time_col: str = "event_time", length: str = "1 second",
                    slide: str | None = None, count_col: str = "n") -> DataFrame:
    """A10 (Q1, as coded): per window, the total row count labelled with the
    last key seen, "last" being the greatest ``order_cols``.

    Output: ``window_start, window_end, <key>, <count_col>``.
    """
    staged = df.select(window_col(time_col, length, slide).alias("_w"), key,
                       F.struct(*order_cols).alias("_o"))
    agg = staged.groupBy("_w").agg(F.max_by(key, "_o").alias(key),
                                   F.count(F.lit(1)).alias(count_col))
    return agg.select(*window_bounds(length, slide), key, count_col)


def pack_map(counts: DataFrame, key_col: str = "key", count_col: str = "n",
             group_cols: tuple[str, ...] = ("window_start", "window_end"),
             label: str | Column | None = None) -> DataFrame:
    """One row per window holding ``sum_map`` (key -> count) and a
    label column ``name`` (a literal, or an existing column when the counts
    come from ``counts_by_name``).

    A map key cannot be null in Spark, so a null key's count is kept whole in
    ``null_key_count`` (null when there is none). The map holds one entry per
    distinct key of the window: use it for bounded key sets (project, class,
    method names), not for free text.
    """
    if label is None:
        label_col = F.col("name")
        gcols = [*group_cols, "name"]
    else:
        label_col = F.lit(label) if isinstance(label, str) else label
        gcols = list(group_cols)
    entry = F.struct(F.col(key_col).cast("string").alias("key"), F.col(count_col).alias("value"))
    agg = counts.groupBy(*gcols).agg(
        F.map_from_entries(F.sort_array(F.collect_list(
            F.when(F.col(key_col).isNotNull(), entry)))).alias("sum_map"),
        F.sum(F.when(F.col(key_col).isNull(), F.col(count_col))).alias("null_key_count"))
    return agg.select(*group_cols, label_col.alias("name"), "sum_map", "null_key_count")


def unpack_map(packed: DataFrame, group_cols: tuple[str, ...] = ("window_start", "window_end"),
               count_col: str = "n") -> DataFrame:
    """P6 for maps: back to one row per key, the null-key count included, in
    one pass over ``packed``."""
    entry_t = "struct<key:string,value:bigint>"
    null_entry = F.when(F.col("null_key_count").isNotNull(), F.array(F.struct(
        F.lit(None).cast("string").alias("key"),
        F.col("null_key_count").cast("long").alias("value")))).otherwise(F.array().cast(f"array<{entry_t}>"))
    entries = F.concat(F.map_entries("sum_map").cast(f"array<{entry_t}>"), null_entry)
    return packed.select(*group_cols, "name", F.inline(entries)).select(
        *group_cols, "name", "key", F.col("value").alias(count_col))


SUM_COUNT_FIELDS = ("project_name", "class_name", "method_name", "total_count", "timestamp")


def pack_list(rows: DataFrame, group_cols: tuple[str, ...] = ("window_start", "window_end"),
              fields: tuple[str, ...] = SUM_COUNT_FIELDS) -> DataFrame:
    """One row per window with the list of its count records
    (``sum_count_list``), sorted for a stable order. Bounded by the distinct
    (project, class, method) keys of one window."""
    return rows.groupBy(*group_cols).agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("sum_count_list"))


def unpack_list(packed: DataFrame, group_cols: tuple[str, ...] = ("window_start", "window_end")) -> DataFrame:
    """One row per record of the packed list."""
    return packed.select(*group_cols, F.inline("sum_count_list"))
