"""Stream forms of the jobs (IDs T1-T5, T7-T13, K7, K8, O1 stream).

The batch operators are reused wherever Spark allows them on a stream:
tokenising, parsing, ``window_count``, ``counts_by_name`` (GROUPING SETS),
``conditional_counts`` and stream-static look-ups. Where a batch operator
looks at a whole window again (first time, top-N, look-ups), the stream
aggregates what it can and the batch operator runs on each micro-batch of
closed windows.

Event time: streams parse ``date`` into a TIMESTAMP (``withWatermark``
rejects TIMESTAMP_NTZ). A late row is dropped once the watermark of the
previous micro-batch has passed its window (T4).
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.operators import calllog as cl
from tallyflow.operators import wordcount as wc
from tallyflow.operators import windows as win
from tallyflow.operators.windows import ALL
from tallyflow.sinks import textfile
from tallyflow.sinks.records import append_batch

# Fixed value: the reference's (commented) event-time lag.
DEFAULT_LAG = "5 seconds"


def running_word_count(lines: DataFrame, text_col: str = "value",
                       mode: str = wc.WHITESPACE) -> DataFrame:
    """Running count per word. Write with ``complete``
    (final listing, K7) or ``update`` (changed counts per batch, K8/T11)."""
    return wc.word_count(lines, text_col, mode)


def parsed_with_watermark(messages: DataFrame, value_col: str = "value",
                          lag: str = DEFAULT_LAG) -> DataFrame:
    """Call-log rows with an event-time watermark of ``lag``."""
    return (cl.parse_call_log(messages, value_col, time_type="timestamp")
            .withWatermark("event_time", lag))


def hierarchical_groups(parsed: DataFrame, length: str = "10 seconds",
                        slide: str | None = None, rows: str = ALL) -> DataFrame:
    """A7 on a stream: per-window project/class/method counts with the group's
    first time, in append mode: a window's groups come out together, in the
    micro-batch after the watermark passes its end."""
    return win.window_groups(parsed, "event_time", length, slide, rows)


WATERMARKS = "_watermarks"


def split_late(path: str, length: str, lag: str = DEFAULT_LAG, time_col: str = "event_time"):
    """T4: a ``foreachBatch`` function that keeps late rows as an output of
    their own: ``<path>/late`` and ``<path>/kept``, one folder per micro-batch
    (replay-safe).

    A row is late if the window of ``length`` that holds it had ended by the
    watermark of the micro-batch before: the greatest event time (in whole
    milliseconds) of all batches before that one, less ``lag``. So Spark's
    watermarked windows drop rows: what a batch's own watermark closes it can
    still add to. The greatest times are kept per batch in ``<path>/_watermarks``,
    the latest three, so a replayed batch is judged as it was. Rows without a
    time are kept; they move no watermark.
    """
    lag_ms = win.seconds(lag) * 1000

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = {int(k): v for k, v in json.loads(textfile.read_text(spark, path, WATERMARKS) or "{}").items()}
        earlier = sorted(k for k in seen if k < batch_id)
        late = F.lit(False)
        if len(earlier) > 1 and seen[earlier[-2]] is not None:
            end = F.unix_millis(F.window(time_col, length)["end"])
            late = F.coalesce(end <= seen[earlier[-2]] - lag_ms, F.lit(False))
        # three jobs read the rows, which are made once
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # a window expression turns null times away, so they go round it
            timed, untimed = batch.where(F.col(time_col).isNotNull()), batch.where(F.col(time_col).isNull())
            marked = timed.withColumn("_late", late)
            append_batch(marked.where("_late").drop("_late"), f"{path}/late", batch_id)
            append_batch(marked.where("NOT _late").drop("_late").unionByName(untimed), f"{path}/kept", batch_id)
            newest = timed.agg(F.max(F.unix_millis(time_col))).first()[0]
        finally:
            batch.unpersist()
        high = [x for x in (newest, *(seen[k] for k in earlier[-1:])) if x is not None]
        kept = {k: seen[k] for k in earlier[-2:]} | {batch_id: max(high, default=None)}
        textfile.replace_text(spark, path, WATERMARKS, json.dumps(kept))

    return per_batch


def _started(writer, trigger: dict | None):
    return (writer.trigger(**trigger) if trigger else writer).start()


def roll_up_closed_windows(groups: DataFrame, sink, checkpoint: str, trigger: dict | None = None):
    """A7 + A8 on a stream: the batch first-time step on each micro-batch's
    closed windows; ``sink(rows, batch_id)`` writes them (idempotent per
    ``batch_id``: a failed batch is replayed). State holds one row per window
    and key, never a window's list."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        sink(win.with_first_time(batch), batch_id)

    return _started(groups.writeStream.outputMode("append").foreachBatch(per_batch)
                    .option("checkpointLocation", checkpoint), trigger)


def lookup_stream(requests: DataFrame, answer, sink, checkpoint: str, trigger: dict | None = None):
    """J1-J3 on a stream: ``answer(batch)`` is the batch look-up (hot keys
    salted) of each micro-batch against the state as it then is;
    ``sink(answers, batch_id)`` writes it (idempotent per ``batch_id``)."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        sink(answer(batch), batch_id)

    return _started(requests.writeStream.foreachBatch(per_batch)
                    .option("checkpointLocation", checkpoint), trigger)


def top_n_closed_windows(counts: DataFrame, n: int, key_col: str, sink, checkpoint: str,
                         count_col: str = "n", trigger: dict | None = None):
    """O1 on a stream for any number of keys: ``counts`` is an append-mode
    windowed count (``window_start, window_end, key, count``); append mode
    emits each closed window's complete counts in one micro-batch, so the
    batch top-N (map-side WindowGroupLimit, no per-window list in state) runs
    on each micro-batch and ``sink(top_df, batch_id)`` writes it (idempotent
    per ``batch_id``: a failed batch is replayed)."""
    from tallyflow.operators.topn import top_n_per_group

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        sink(top_n_per_group(batch, n, order_col=count_col, key_col=key_col), batch_id)

    return _started(counts.writeStream.outputMode("append").foreachBatch(per_batch)
                    .option("checkpointLocation", checkpoint), trigger)


def route_stream(messages: DataFrame, sinks: dict, checkpoint: str,
                 value_col: str = "value", trigger: dict | None = None):
    """P8 on a stream: the named sub-streams of ``calllog.route`` (general,
    status, result_code), each written by ``sinks[name](df, batch_id)``.

    One ``foreachBatch`` parses each micro-batch once and persists it while
    every named branch is written, so the source is read once per batch; the
    cache is released after. A lost executor's cached blocks are recomputed
    from the replayable batch. Sinks should be idempotent per ``batch_id``
    (e.g. overwrite ``<path>/batch_id=N``): a failed batch is replayed.
    """
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = cl.parse_call_log(batch, value_col).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            branches = cl.route(parsed)
            for name, sink in sinks.items():
                sink(branches[name], batch_id)
        finally:
            parsed.unpersist()

    return _started(messages.writeStream.foreachBatch(per_batch)
                    .option("checkpointLocation", checkpoint), trigger)


def observe_rows(df: DataFrame, name: str) -> DataFrame:
    """A pass-through side channel: row count per batch, reported
    in the query progress (``observedMetrics``) without changing ``df``."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))
