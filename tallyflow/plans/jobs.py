"""The reference's five jobs as end-to-end compositions.

Each job has a batch form (DataFrame in, DataFrame out) and, where the
reference runs continuously, a stream form that starts a checkpointed
``StreamingQuery``. Checkpoints and snapshot tables live under the shared
folder named by ``spark.checkpoint.dir`` unless a path is given.

J-WC    word count over a text topic               -> ``word_count_*``
J-LOG   call logs -> 10 s roll-up -> daily index   -> ``log_rollup_*``
J-ROLL  1 s project counts -> keyed store -> look-up -> ``rolling_*``
J-DRPC  running word count + look-up by word       -> ``word_lookup_*``
J-KTEST sentences/records to a topic + word look-up -> ``topic_*``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyflow.functions.timecols import to_event_time
from tallyflow.operators import calllog as cl
from tallyflow.operators import lookup as lk
from tallyflow.operators import state as st
from tallyflow.operators import windows as win
from tallyflow.operators import wordcount as wc
from tallyflow.session import sub_dir
from tallyflow.sinks.documents import index_documents, write_documents_batch
from tallyflow.sinks.keyed_store import KeyedStore
from tallyflow.sinks.records import to_records, write_records_stream
from tallyflow.sinks.snapshot import KeyedSnapshot
from tallyflow.sources.streams import StreamSpec, read_stream
from tallyflow.streaming import forms
from tallyflow.streaming.state import read_state

# The reference jobs' window settings.
LOG_WINDOW = "10 seconds"       # J-LOG length = slide
ROLL_WINDOW = "1 second"        # J-ROLL tumbling window
ROLL_TTL_SECONDS = 300          # J-ROLL hash-store expiry


# -- J-WC ---------------------------------------------------------------------

def word_count_batch(lines: DataFrame, text_col: str = "line") -> DataFrame:
    """Whitespace-run word count (final result, K7)."""
    return wc.running_sum(wc.word_weights(lines, text_col, wc.WHITESPACE))


def word_count_stream(spark: SparkSession, spec: StreamSpec, checkpoint: str | None = None,
                      output_mode: str = "update", query_name: str = "word_count",
                      trigger: dict | None = None, foreach_batch=None,
                      mode: str = wc.WHITESPACE) -> StreamingQuery:
    """Running word count; ``update`` emits each changed count (K8),
    ``complete`` the whole listing (K7). Output goes to ``foreach_batch``
    (restartable from the checkpoint; it must execute the batch, or the
    state of that batch is not committed).
    ``mode``: whitespace-run tokens (J-WC) or single-space tokens (the
    J-DRPC state that ``word_lookup_stream`` serves)."""
    if foreach_batch is None:
        raise ValueError("word_count_stream needs a foreach_batch sink")
    counts = forms.running_word_count(read_stream(spark, spec), "value", mode)
    w = (counts.writeStream.outputMode(output_mode).foreachBatch(foreach_batch)
         .option("checkpointLocation", checkpoint or sub_dir(spark, f"ckpt/{query_name}")))
    return (w.trigger(**trigger) if trigger else w).start()


# -- J-LOG --------------------------------------------------------------------

def log_rollup_batch(messages: DataFrame, length: str = LOG_WINDOW, slide: str | None = None,
                     rows: str = win.ALL, day_col: str | None = "timestamp") -> DataFrame:
    """Parse -> dispatch -> hierarchical window counts -> index documents."""
    general = cl.general_stream(cl.parse_call_log(messages))
    counts = win.hierarchical_count(general, length=length, slide=slide, rows=rows)
    return index_documents(counts, day_col)


def log_rollup_stream(spark: SparkSession, spec: StreamSpec, out_path: str,
                      checkpoint: str | None = None, length: str = LOG_WINDOW,
                      lag: str = forms.DEFAULT_LAG, trigger: dict | None = None,
                      output_files: int | None = None, slide: str | None = None,
                      rows: str = win.ALL) -> StreamingQuery:
    """The same on a stream, written to daily-index folders, each micro-batch
    in its own (replay-safe); ``output_files`` bounds the files written per
    micro-batch and day."""
    parsed = forms.parsed_with_watermark(read_stream(spark, spec), "value", lag)

    def sink(rows: DataFrame, batch_id: int) -> None:
        write_documents_batch(index_documents(rows, "timestamp"), out_path, batch_id,
                              output_files=output_files)

    return forms.roll_up_closed_windows(forms.hierarchical_groups(parsed, length, slide, rows), sink,
                                        checkpoint or sub_dir(spark, "ckpt/log_rollup"), trigger)


# -- J-ROLL -------------------------------------------------------------------

def _project_rows(messages: DataFrame, time_type: str) -> DataFrame:
    rows = cl.json_key_filter(messages, "projectName", fields={"ts_ms": ("date", "bigint")})
    ts = F.coalesce("ts_ms", F.lit(0).cast("long"))
    return rows.select("projectName", to_event_time(ts, time_type).alias("event_time"))


def rolling_state_batch(messages: DataFrame, length: str = ROLL_WINDOW,
                        ttl_seconds: int | None = ROLL_TTL_SECONDS, as_of=None) -> DataFrame:
    """Per-project window counts -> latest count per project -> live keys
    (the whole table expires together, ``as_of`` now by default)."""
    counts = win.window_count(_project_rows(messages, "timestamp_ntz"), ["projectName"],
                              length=length, count_col="num")
    latest = st.latest_per_key(counts, "projectName", "num", "window_end", out_value="count")
    if ttl_seconds is None:
        return latest
    writes = counts.select(F.col("window_end").alias("updated_at"))
    return st.live_state(latest, "updated_at", ttl_seconds, as_of, st.TABLE, writes)


def rolling_snapshot(spark: SparkSession, path: str | None = None,
                     ttl_seconds: int | None = ROLL_TTL_SECONDS) -> KeyedSnapshot:
    """The keyed store (K2): projectName -> count; the whole store expires
    when nothing was written for the TTL."""
    return KeyedSnapshot(spark, path or sub_dir(spark, "snapshots/rolling_state"),
                         ("projectName",), ("count",), "updated_at", ttl_seconds, st.TABLE)


def rolling_store(spark: SparkSession, path: str | None = None, ttl_seconds: int | None = ROLL_TTL_SECONDS,
                  **layout) -> KeyedStore:
    """The same store merged on reading, for key sets of any size: a batch
    writes its own keys, a look-up opens the buckets of its keys."""
    return KeyedStore(spark, path or sub_dir(spark, "stores/rolling_state"), ("projectName",), ("count",),
                      "updated_at", ttl_seconds, st.TABLE, **layout)


def rolling_stream(spark: SparkSession, spec: StreamSpec, snapshot: KeyedSnapshot | KeyedStore,
                   checkpoint: str | None = None, length: str = ROLL_WINDOW,
                   lag: str = forms.DEFAULT_LAG, trigger: dict | None = None) -> StreamingQuery:
    """Per-project window counts on a stream; every micro-batch of closed
    windows is upserted into the keyed store (idempotent per batch id)."""
    rows = _project_rows(read_stream(spark, spec), "timestamp").withWatermark("event_time", lag)
    counts = win.window_count(rows, ["projectName"], length=length, count_col="num")
    upd = counts.select("projectName", F.col("num").alias("count"),
                        F.col("window_end").alias("updated_at"))
    w = (upd.writeStream.outputMode("append").foreachBatch(snapshot.foreach_batch())
         .option("checkpointLocation", checkpoint or sub_dir(spark, "ckpt/rolling")))
    return (w.trigger(**trigger) if trigger else w).start()


def rolling_lookup(requests: DataFrame, state: DataFrame, on_miss: str = lk.NULL) -> DataFrame:
    """Requests ``(request_id, args)`` answered from the keyed store; misses
    kept as null text (the active variant) or 0 (the in-memory variant)."""
    toks = lk.request_tokens(requests, key_col="arg")
    store = state if on_miss != lk.NULL else st.store_records(state, "projectName", "count",
                                                              "projectName", "count")
    out = lk.lookup(toks, store, key_col="arg", state_key="projectName", value_col="count",
                    on_miss=on_miss)
    return out.withColumnRenamed("arg", "projectName")


def store_lookup(req_tokens: DataFrame, store: KeyedStore, key_col: str, value_col: str = "count",
                 on_miss: str = lk.NULL, as_of=None) -> DataFrame:
    """J1-J3 against a keyed store of one key column, opening only the part
    that the requested keys hash to."""
    key = store.key_cols[0]
    state = store.read_keys(req_tokens.select(F.col(key_col).alias(key)), as_of)
    return lk.lookup(req_tokens, state, key_col, key, value_col, on_miss)


def rolling_lookup_stream(spark: SparkSession, requests: DataFrame, snapshot: KeyedSnapshot | KeyedStore, sink,
                          checkpoint: str | None = None, on_miss: str = lk.NULL,
                          trigger: dict | None = None) -> StreamingQuery:
    """A stream of requests answered from the keyed store as it stands at each
    micro-batch; ``sink(answers_df, batch_id)`` writes the answers. Of a
    ``KeyedStore`` only the requested part is read."""
    def answer(batch: DataFrame) -> DataFrame:
        if isinstance(snapshot, KeyedSnapshot):
            return rolling_lookup(batch, snapshot.read(), on_miss)
        toks = lk.request_tokens(batch, key_col="arg")
        return store_lookup(toks, snapshot, "arg", on_miss=on_miss).withColumnRenamed("arg", "projectName")

    return forms.lookup_stream(requests, answer, sink, checkpoint or sub_dir(spark, "ckpt/rolling_lookup"), trigger)


# -- J-DRPC -------------------------------------------------------------------

def word_state_batch(lines: DataFrame, text_col: str = "line") -> DataFrame:
    """Running count per single-space token (the state)."""
    return wc.word_count(lines, text_col, wc.SPACE)


def word_lookup(requests: DataFrame, state: DataFrame, on_miss: str = lk.DROP) -> DataFrame:
    """Request tokens answered from the word state; misses dropped."""
    toks = lk.request_tokens(requests, key_col="word")
    return lk.lookup(toks, state, key_col="word", value_col="count", on_miss=on_miss)


def word_state_from_stream(spark: SparkSession, state_checkpoint: str) -> DataFrame:
    """The running word count's committed state (S5) as ``(word, count)``."""
    st = read_state(spark, state_checkpoint)
    return st.select(F.col("key.word").alias("word"), F.col("value.count").alias("count"))


def word_lookup_stream(spark: SparkSession, requests: DataFrame, state_checkpoint: str,
                       sink, checkpoint: str | None = None, on_miss: str = lk.DROP,
                       trigger: dict | None = None) -> StreamingQuery:
    """Requests answered from the live word-count state.

    Each micro-batch of ``requests`` (``request_id, args``) is joined to the
    state last committed by the word-count query at ``state_checkpoint``,
    read through the state reader, with the batch look-up plan (distinct
    keys first, hot keys salted). ``sink(answers_df, batch_id)`` writes the
    answers; make it idempotent per ``batch_id`` (a failed batch is replayed).
    """
    def answer(batch: DataFrame) -> DataFrame:
        return word_lookup(batch, word_state_from_stream(spark, state_checkpoint), on_miss)

    return forms.lookup_stream(requests, answer, sink, checkpoint or sub_dir(spark, "ckpt/word_lookup"), trigger)


# -- J-KTEST ------------------------------------------------------------------

def sentence_records(lines: DataFrame, text_col: str = "line") -> DataFrame:
    """Producer: each sentence to a topic record; its rows carry no ``key``
    field, so the key is null (K4)."""
    return to_records(lines, "key", text_col)


def word_count_records(word_counts: DataFrame) -> DataFrame:
    """(word, count) to topic records: key = word, value = count text (K5)."""
    return to_records(word_counts, "word", "count")


def topic_records_stream(records: DataFrame, spark: SparkSession, path: str | None = None,
                         checkpoint: str | None = None, topic: str | None = None,
                         bootstrap_servers: str | None = None,
                         trigger: dict | None = None) -> StreamingQuery:
    """Records to a topic (``topic``) or JSON files (``path``), append mode."""
    return write_records_stream(records, checkpoint or sub_dir(spark, "ckpt/records"), path,
                                topic, bootstrap_servers, "append", trigger)
