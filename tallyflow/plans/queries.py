"""Registered queries: the reference's operators over the driver tables.

Each function reads whole tables through the adapters in
``tallyflow.sources.adapters`` and composes operators; nothing is collected
and no row is capped. Window lengths are chosen for the event density of the
driver tables (events lie minutes apart, so 10 s windows hold about one row);
``hierarchical_count_10s`` keeps the reference's own 10 s window.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow import schemas
from tallyflow.functions.timecols import millis_to_ntz, ntz_to_millis, write_time
from tallyflow.operators import calllog as cl
from tallyflow.operators import lookup as lk
from tallyflow.operators import panes
from tallyflow.operators import rolling
from tallyflow.operators import state as st
from tallyflow.operators import topn
from tallyflow.operators import windows as win
from tallyflow.operators import wordcount as wc
from tallyflow.operators.asof import as_of
from tallyflow.plans import jobs
from tallyflow.session import sub_dir, with_conf
from tallyflow.sinks.documents import index_documents as to_documents
from tallyflow.sinks.documents import write_documents_batch, write_or_refuse
from tallyflow.sinks.keyed_store import KeyedStore
from tallyflow.sinks.records import append_batch, to_records
from tallyflow.sinks.snapshot import KeyedSnapshot
from tallyflow.sinks.sorted_set import SortedSet
from tallyflow.sources import adapters
from tallyflow.sources.literal import request_strings
from tallyflow.sources.streams import file_spec, in_slices, read_stream, write_feed
from tallyflow.sources.tables import spread, table
from tallyflow.streaming import forms
from tallyflow.streaming.state import CHANGE_FEED_CONF, read_changes, read_state

HOUR = "1 hour"
QUARTER = "15 minutes"
MINUTE = "1 minute"
SECOND = "1 second"
TOP_N = 2
TOP_WORDS = 20
EXCLAIM_TIMES = 10

# Request strings of the reference's project look-up demos,
# plus one of ours with a repeat and a miss.
PROJECT_REQUESTS = ("openstacklog test", "test openstacklog test2", "p1 zz p2")


# -- inputs -----------------------------------------------------------------

def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.lines(spread(table(spark, sf_dir, "documents"), "doc_id"))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.call_log_messages(spread(table(spark, sf_dir, "events"), "event_id"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.parse_call_log(_messages(spark, sf_dir))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.requests(table(spark, sf_dir, "conversations"))


def _request_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lk.request_tokens(_requests(spark, sf_dir), id_cols=("conv_id", "turn"), key_col="word")


def _project_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-ROLL input: ``projectName`` (strict) and the message time."""
    rows = cl.json_key_filter(_messages(spark, sf_dir), "projectName",
                              fields={"ts_ms": ("date", "bigint")})
    return rows.select("projectName",
                       millis_to_ntz(F.coalesce("ts_ms", F.lit(0).cast("long"))).alias("event_time"))


# -- J-WC / J-DRPC / J-KTEST: words ----------------------------------------

def word_count_space(spark, sf_dir):
    """J-DRPC state, single-space tokens."""
    return wc.word_count(_lines(spark, sf_dir), "line", wc.SPACE)


def word_count_ws(spark, sf_dir):
    """J-WC, whitespace-run tokens with Java split rules."""
    return wc.running_sum(wc.word_weights(_lines(spark, sf_dir), "line", wc.WHITESPACE))


def sentence_records(spark, sf_dir):
    """K4 P10: each text message to a topic record; the rows carry no key
    field, so the key is null."""
    # no per-row work, so no spread: the scan feeds the records directly
    return to_records(adapters.lines(table(spark, sf_dir, "documents")), "key", "line")


def topic_records(spark, sf_dir):
    """K4 K5 P10 C14: (word, count) as topic records (key, value text)."""
    return st.store_records(word_count_space(spark, sf_dir), "word", "count")


def top_words(spark, sf_dir):
    """O2 K6: words ranked by count (sorted-set listing), ranks <= 20."""
    return topn.rank_top(word_count_space(spark, sf_dir), TOP_WORDS, "count", "word")


def _lookup(spark, sf_dir, on_miss):
    return lk.lookup(_request_tokens(spark, sf_dir), word_count_space(spark, sf_dir),
                     key_col="word", value_col="count", on_miss=on_miss)


def lookup_drop(spark, sf_dir):
    """Request tokens answered from the word state, misses dropped."""
    return _lookup(spark, sf_dir, lk.DROP)


def lookup_zero(spark, sf_dir):
    """Misses answered with 0."""
    return _lookup(spark, sf_dir, lk.ZERO)


def lookup_null(spark, sf_dir):
    """Misses kept with null; counts as text."""
    return _lookup(spark, sf_dir, lk.NULL)


def lookup_identity(spark, sf_dir):
    """The identity query function over request tokens."""
    return lk.lookup_identity(_request_tokens(spark, sf_dir), key_col="word")


def exclaim_n(spark, sf_dir):
    """Each request answered with ten marks appended."""
    return lk.exclaim_reply(_requests(spark, sf_dir), id_cols=("conv_id", "turn"),
                            times=EXCLAIM_TIMES)


# -- J-LOG: call-log roll-up -----------------------------------------------

def parse_call_log(spark, sf_dir):
    """Parsed call-log fields, numbers in text fields as text."""
    return cl.parse_call_log(_messages(spark, sf_dir), mode=cl.COERCE).drop("output_info")


def parse_call_log_strict(spark, sf_dir):
    """C4 C5 (strict): the same fields through the type-checked parse."""
    return cl.parse_call_log(_messages(spark, sf_dir), mode=cl.STRICT).drop("output_info")


def json_key_strict(spark, sf_dir):
    """F2 C5 (strict): call-log messages holding a text projectName."""
    rows = cl.json_key_filter(_messages(spark, sf_dir), "projectName", mode=cl.STRICT,
                              fields={"msg_id": ("id", "string")})
    return rows.select("msg_id", "projectName")


def json_key_filter(spark, sf_dir):
    """F2 C5 (coerce): events.props objects holding ``k``, value as text."""
    ev = table(spark, sf_dir, "events")
    return cl.json_key_filter(ev, "k", value_col="props", mode=cl.COERCE, keep=("event_id",))


def json_rejects(spark, sf_dir):
    """messages that are not JSON objects (raw web pages fed to the
    projectName filter) come out as rejects, whole."""
    pages = table(spark, sf_dir, "pages")
    return cl.json_key_rejects(pages, "projectName", value_col="html", keep=("page_id",))


def window_count_by_name(spark, sf_dir):
    """Per-hour counts by project, class and method in one pass."""
    return win.counts_by_name(_parsed(spark, sf_dir), length=HOUR)


def window_count_class(spark, sf_dir):
    """Per-class counts in the reference's 10 s windows (length =
    slide), the class key taken from the message's clazz."""
    return win.window_count(_parsed(spark, sf_dir), ["class_name"], length="10 seconds",
                            slide="10 seconds")


def sliding_count(spark, sf_dir):
    """T2 T5 (all rows): 1 h windows sliding by 15 min, per class."""
    return win.window_count(_parsed(spark, sf_dir), ["class_name"], length=HOUR,
                            slide=QUARTER, rows=win.ALL)


def sliding_count_new(spark, sf_dir):
    """T5 (new rows): the same windows counting only their last 15 min."""
    return win.window_count(_parsed(spark, sf_dir), ["class_name"], length=HOUR,
                            slide=QUARTER, rows=win.NEW)


def hierarchical_count(spark, sf_dir):
    """Per-hour project -> class -> method counts + first time."""
    return win.hierarchical_count(_parsed(spark, sf_dir), length=HOUR)


def hierarchical_count_10s(spark, sf_dir):
    """A7 A8 with the reference's 10 s tumbling window."""
    return win.hierarchical_count(_parsed(spark, sf_dir), length="10 seconds")


def conditional_counts(spark, sf_dir):
    """login/register success counts per hour, zeros left out."""
    codes = cl.result_codes(_parsed(spark, sf_dir))
    return win.conditional_counts(codes, "return_code", length=HOUR)


def window_total(spark, sf_dir):
    """Rows per hour."""
    return win.window_total(_parsed(spark, sf_dir), length=HOUR)


def window_last_key(spark, sf_dir):
    """A10 (Q1 as coded): rows per hour labelled with the last project."""
    return win.window_last_key(_parsed(spark, sf_dir), "project_name", length=HOUR)


def pack_map(spark, sf_dir):
    """Per-window name -> count maps, unpacked again for comparison."""
    packed = win.pack_map(win.counts_by_name(_parsed(spark, sf_dir), length=HOUR))
    return win.unpack_map(packed)


def pack_list(spark, sf_dir):
    """Per-window lists of count records, unpacked again."""
    packed = win.pack_list(win.hierarchical_count(_parsed(spark, sf_dir), length=HOUR))
    return win.unpack_list(packed)


def index_documents(spark, sf_dir):
    """Hierarchical counts as daily-index documents (index day
    from event time; the write-time column is left out of the check)."""
    rows = win.hierarchical_count(_parsed(spark, sf_dir), length=HOUR)
    docs = to_documents(rows, "timestamp", stamp_write_time=False)
    return docs.drop("window_start", "window_end")


def status_route(spark, sf_dir):
    """Messages whose outputInfo.meta.code is 0."""
    return cl.status_route(_parsed(spark, sf_dir))


def rolling_top_n(spark, sf_dir):
    """O1: the two busiest classes per hour (ties by name)."""
    counts = win.window_count(_parsed(spark, sf_dir), ["class_name"], length=HOUR)
    return topn.top_n_per_group(counts, TOP_N, order_col="n", key_col="class_name")


def rolling_top_users(spark, sf_dir):
    """The ten busiest users per day, every six hours (ties by id), by
    a sketch of fixed size per pane."""
    events = table(spark, sf_dir, "events").select(F.col("ts").alias("event_time"), "user_id")
    return rolling.rolling_top_n(events, 10, key_col="user_id", length=86400, slide=21600)


def rank_latest(spark, sf_dir):
    """K6 O2 A4: the sorted-set listing: each class's count in its latest
    hour, ranked by that count (ties share a rank), ranks <= 3."""
    counts = win.window_count(_parsed(spark, sf_dir), ["class_name"], length=HOUR)
    latest = st.latest_per_key(counts, "class_name", "n", "window_end")
    return topn.rank_top(latest, 3, order_col="n", key_col="class_name")


# -- J-ROLL: rolling project counts, keyed state, look-up --------------------

def window_count_project(spark, sf_dir):
    """Messages with a text projectName, counted per project per
    window (the per-key form of the rolling count)."""
    return win.window_count(_project_keyed(spark, sf_dir), ["projectName"],
                            length=MINUTE, count_col="num")


def latest_per_key(spark, sf_dir):
    """A4: each project's count in its latest window."""
    return st.latest_per_key(window_count_project(spark, sf_dir), "projectName",
                             "num", "window_end", out_value="count")


def _soon_after(writes: DataFrame):
    """The point in time at which the state queries look: two minutes after
    the last write."""
    return writes.select(F.max("updated_at")).scalar() + F.expr("INTERVAL '120' SECOND")


def latest_with_ttl(spark, sf_dir):
    """The keyed state two minutes after the last write: the keys
    written since the last pause of more than 300 s."""
    counts = window_count_project(spark, sf_dir)
    latest = st.latest_per_key(counts, "projectName", "num", "window_end", out_value="count")
    writes = counts.select(F.col("window_end").alias("updated_at"))
    return st.live_state(latest, "updated_at", st.DEFAULT_TTL_SECONDS, _soon_after(writes), st.TABLE, writes)


def hash_store_records(spark, sf_dir):
    """K2 P10 C14: live state as hash-store entries (count as text)."""
    return st.store_records(latest_with_ttl(spark, sf_dir), "projectName", "count",
                            "projectName", "count")


def project_lookup_null(spark, sf_dir):
    """The reference's request strings against the hash store; misses
    kept as null, counts as text."""
    req = lk.request_tokens(request_strings(spark, PROJECT_REQUESTS), key_col="arg")
    store = hash_store_records(spark, sf_dir)
    out = lk.lookup(req, store, key_col="arg", state_key="projectName",
                    value_col="count", on_miss=lk.NULL)
    return out.select("request_id", "pos", F.col("arg").alias("projectName"), "count")


def _user_state(spark, sf_dir):
    """Per user the number of events in their latest second, and all writes."""
    counts = win.window_count(table(spark, sf_dir, "events"), ["user_id"], time_col="ts", length=SECOND)
    writes = counts.select(F.col("window_end").alias("updated_at"))
    return st.latest_per_key(counts, "user_id", "n", "window_end"), writes


def state_ttl_key(spark, sf_dir):
    """T6, each key by itself: the users written within six hours."""
    latest, writes = _user_state(spark, sf_dir)
    return st.live_state(latest, "updated_at", 6 * 3600, _soon_after(writes), st.KEY)


def state_ttl_table(spark, sf_dir):
    """T6, the table as a whole: the users written since the last pause of
    more than twenty minutes."""
    latest, writes = _user_state(spark, sf_dir)
    return st.live_state(latest, "updated_at", 1200, _soon_after(writes), st.TABLE, writes)


# -- windows and rankings beyond the first set ---------------------------------

def hierarchical_new(spark, sf_dir):
    """T5 A7 A8 (new rows): 10 min windows every 4 min, which do not divide."""
    return win.hierarchical_count(_parsed(spark, sf_dir), length="10 minutes", slide="4 minutes", rows=win.NEW)


def conditional_new(spark, sf_dir):
    """T5 A6 (new rows): code counts of the last 4 min of 10 min windows."""
    codes = cl.result_codes(_parsed(spark, sf_dir))
    return win.conditional_counts(codes, "return_code", length="10 minutes", slide="4 minutes", rows=win.NEW)


def general_stream(spark, sf_dir):
    """The dispatch step's rows."""
    return cl.general_stream(_parsed(spark, sf_dir))


def window_count_project_1s(spark, sf_dir):
    """A11 with the reference's one-second window."""
    return win.window_count(_project_keyed(spark, sf_dir), ["projectName"], length=SECOND, count_col="num")


def window_last_key_1s(spark, sf_dir):
    """A10 with the reference's one-second window."""
    return win.window_last_key(_parsed(spark, sf_dir), "project_name", length=SECOND)


def ranking_store(spark, sf_dir):
    """K6: the ranking written as a store and read back."""
    path = _folder(spark, "ranking")
    topn.store_ranking(top_words(spark, sf_dir), path, "count", "word")
    return spark.read.parquet(path)


# -- messages that can fail ------------------------------------------------------

def _mixed(spark, sf_dir):
    return adapters.mixed_messages(*(table(spark, sf_dir, t) for t in ("events", "pages", "conversations")))


def mixed_parse_strict(spark, sf_dir):
    """Messages amid other text; other types read as null."""
    return cl.parse_call_log(_mixed(spark, sf_dir), mode=cl.STRICT).drop("output_info")


def mixed_parse_coerce(spark, sf_dir):
    """The same; numbers read as text."""
    return cl.parse_call_log(_mixed(spark, sf_dir), mode=cl.COERCE).drop("output_info")


def mixed_rejects_strict(spark, sf_dir):
    """what the strict parse leaves out."""
    return cl.call_log_rejects(_mixed(spark, sf_dir), mode=cl.STRICT)


def mixed_rejects_coerce(spark, sf_dir):
    """what the coercing parse leaves out."""
    return cl.call_log_rejects(_mixed(spark, sf_dir), mode=cl.COERCE)


def mixed_key_strict(spark, sf_dir):
    """Objects with a text projectName, amid objects without one, with
    a number, and other text."""
    return cl.json_key_filter(_mixed(spark, sf_dir), "projectName", mode=cl.STRICT).select("projectName", "value")


def mixed_key_coerce(spark, sf_dir):
    """The same; a number reads as text."""
    return cl.json_key_filter(_mixed(spark, sf_dir), "projectName", mode=cl.COERCE).select("projectName", "value")


def mixed_identity(spark, sf_dir):
    """The identity function over keys of which some are null."""
    rows = cl.parse_call_log(_mixed(spark, sf_dir)).select("msg_id", "project_name")
    return lk.lookup_identity(rows, "project_name")


# -- streams: whole availableNow runs over the tables ----------------------------

def _folder(spark, name):
    """A new folder under the shared checkpoint folder."""
    return sub_dir(spark, f"{name}-{uuid.uuid4().hex}")


def _stream(spark, sf_dir, name, max_files_per_trigger=1000):
    return read_stream(spark, file_spec(spark, f"{sf_dir}/{name}.parquet", file_format="parquet",
                                        schema=schemas.TABLE_SCHEMAS[name], max_files_per_trigger=max_files_per_trigger))


def _event_stream(spark, sf_dir):
    """The call-log messages without a file limit, so that availableNow takes
    all files in one micro-batch: files come by modification time, and between
    micro-batches the watermark would drop rows of files out of event order."""
    return adapters.call_log_messages(_stream(spark, sf_dir, "events", max_files_per_trigger=None))


NOW = {"availableNow": True}


def stream_word_state(spark, sf_dir):
    """A running word count over the documents; the state
    it keeps, read back as a relation."""
    path = _folder(spark, "stream-words")
    counts = forms.running_word_count(_stream(spark, sf_dir, "documents"), "text", wc.SPACE)
    (counts.writeStream.outputMode("update").trigger(**NOW).option("checkpointLocation", path)
     .foreachBatch(lambda b, i: b.write.format("noop").mode("overwrite").save()).start().awaitTermination())
    return read_state(spark, path).select(F.col("key.word").alias("word"), F.col("value.count").alias("count"))


def stream_word_changes(spark, sf_dir):
    """The changed counts of every micro-batch, appended; the last one
    per word."""
    path = _folder(spark, "stream-changes")
    counts = forms.running_word_count(_stream(spark, sf_dir, "documents"), "text", wc.SPACE)
    (counts.writeStream.outputMode("update").trigger(**NOW).option("checkpointLocation", f"{path}/ckpt")
     .foreachBatch(lambda b, i: append_batch(b, f"{path}/out", i)).start().awaitTermination())
    rows = spark.read.parquet(f"{path}/out")
    return rows.groupBy("word").agg(F.max_by("count", "batch_id").alias("count"))


def stream_log_rollup(spark, sf_dir):
    """The roll-up stream into daily-index documents, for the
    windows that the watermark has closed."""
    path = _folder(spark, "stream-rollup")
    parsed = forms.parsed_with_watermark(_event_stream(spark, sf_dir))

    def sink(rows, batch_id):
        docs = to_documents(rows, "timestamp", stamp_write_time=False)
        write_documents_batch(docs.drop("window_start", "window_end"), f"{path}/out", batch_id)

    forms.roll_up_closed_windows(forms.hierarchical_groups(parsed), sink, f"{path}/ckpt", NOW).awaitTermination()
    docs = spark.read.schema("project_name string, class_name string, method_name string, total_count long, "
                             "timestamp timestamp, _type string, _index string, batch_id long").json(f"{path}/out")
    return docs.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).drop("batch_id")


def _project_stream(spark, sf_dir):
    rows = cl.json_key_filter(_event_stream(spark, sf_dir), "projectName",
                              fields={"ts_ms": ("date", "bigint")})
    timed = rows.select("projectName", F.timestamp_millis(F.coalesce("ts_ms", F.lit(0).cast("long"))).alias("event_time"))
    return win.window_count(timed.withWatermark("event_time", forms.DEFAULT_LAG), ["projectName"], length=SECOND,
                            count_col="num")


def stream_window_rows(spark, sf_dir):
    """The closed one-second windows of the stream, appended as state."""
    path = _folder(spark, "stream-windows")
    (_project_stream(spark, sf_dir).writeStream.outputMode("append").trigger(**NOW)
     .option("checkpointLocation", f"{path}/ckpt")
     .foreachBatch(lambda b, i: append_batch(b, f"{path}/out", i)).start().awaitTermination())
    rows = spark.read.parquet(f"{path}/out")
    ntz = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    return rows.select(*ntz, "projectName", "num")


def stream_keyed_store(spark, sf_dir):
    """Closed windows upserted into the keyed store, each batch
    replayable; the store read back."""
    path = _folder(spark, "stream-store")
    snap = KeyedSnapshot(spark, f"{path}/store", ("projectName",), ("count",), "updated_at")
    upd = _project_stream(spark, sf_dir).select("projectName", F.col("num").alias("count"),
                                                F.col("window_end").alias("updated_at"))

    def twice(batch, batch_id):
        snap.upsert(batch, batch_id)
        snap.upsert(batch, batch_id)        # as a replayed batch

    (upd.writeStream.outputMode("append").trigger(**NOW).option("checkpointLocation", f"{path}/ckpt")
     .foreachBatch(twice).start().awaitTermination())
    return snap.read().withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


def observed_rows(spark, sf_dir):
    """The side channel that counts rows changes none."""
    return forms.observe_rows(_lines(spark, sf_dir), "lines_seen")


def write_time_stamp(spark, sf_dir):
    """Documents stamped with the time of writing, which lies between
    the query's start and its end."""
    start = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    docs = to_documents(general_stream(spark, sf_dir), "event_time")
    ok = (F.col("@timestamp") >= F.lit(start)) & (F.col("@timestamp") <= write_time())
    return docs.select("_index", "_type", "ts_ms", ok.alias("stamped"))


# -- streams of several micro-batches: the tables as feeds in a known order --------

SLICES = 6
WORD_SLICES = 4


def _event_feed(spark, sf_dir, path, late=False):
    """The call-log messages in ``SLICES`` micro-batches by time. With ``late``
    events come after their time by the rule on event_id: every 11th one slice
    later, every 17th two (both: three)."""
    ev = in_slices(table(spark, sf_dir, "events"), ntz_to_millis("ts"), SLICES)
    if late:
        delay = F.when(F.col("event_id") % 11 == 0, 1).otherwise(0) + F.when(F.col("event_id") % 17 == 0, 2).otherwise(0)
        ev = ev.withColumn("_slice", F.least(F.col("_slice") + delay, F.lit(SLICES - 1)))
    spec = write_feed(ev, f"{path}/feed", SLICES)
    return adapters.call_log_messages(read_stream(spark, spec))


def _word_feed(spark, sf_dir, path):
    docs = in_slices(table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("doc_id"), WORD_SLICES)
    return read_stream(spark, write_feed(docs, f"{path}/feed", WORD_SLICES))


def _run(writer, path):
    q = writer.trigger(**NOW).option("checkpointLocation", f"{path}/ckpt").start()
    q.awaitTermination()
    return q


def stream_kept_windows(spark, sf_dir):
    """A feed in which some rows are late; the one-minute windows that
    Spark's watermark closed, without the rows it dropped."""
    path = _folder(spark, "stream-kept")
    parsed = forms.parsed_with_watermark(_event_feed(spark, sf_dir, path, late=True))
    counts = win.window_count(parsed, ["project_name"], length=MINUTE)
    _run(counts.writeStream.outputMode("append").foreachBatch(lambda b, i: append_batch(b, f"{path}/out", i)), path)
    ntz = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    return spark.read.parquet(f"{path}/out").select(*ntz, "project_name", "n")


def stream_late_rows(spark, sf_dir):
    """T4: the same feed; the late rows as an output of their own."""
    path = _folder(spark, "stream-late")
    parsed = cl.parse_call_log(_event_feed(spark, sf_dir, path, late=True), time_type="timestamp")
    _run(parsed.select("msg_id", "project_name", "event_time").writeStream
         .foreachBatch(forms.split_late(f"{path}/out", MINUTE)), path)
    rows = spark.read.parquet(f"{path}/out/late")
    return rows.select(F.col("batch_id").cast("long").alias("batch_id"), "msg_id", "project_name", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


def stream_state_changes(spark, sf_dir):
    """What each micro-batch changed in the word count's state, with
    the count before and after, from the state store's change feed."""
    path = _folder(spark, "stream-feed")
    counts = forms.running_word_count(_word_feed(spark, sf_dir, path), "text", wc.SPACE)
    with with_conf(spark, CHANGE_FEED_CONF):
        _run(counts.writeStream.outputMode("update")
             .foreachBatch(lambda b, i: b.write.format("noop").mode("overwrite").save()), path)
    return read_changes(spark, f"{path}/ckpt").select(
        F.col("batch_id").cast("long").alias("batch_id"), F.col("key.word").alias("word"),
        F.col("before.count").alias("before"), F.col("after.count").alias("after"))


def stream_rate_limit(spark, sf_dir):
    """A feed of several files under a file limit; per micro-batch the
    rows it took and the rows that the side channel observed."""
    path = _folder(spark, "stream-limit")
    rows = forms.observe_rows(_word_feed(spark, sf_dir, path), "lines_seen")
    q = _run(rows.writeStream.foreachBatch(lambda b, i: b.write.format("noop").mode("overwrite").save()), path)
    seen = [(p["batchId"], p["numInputRows"], p["observedMetrics"]["lines_seen"]["rows"]) for p in q.recentProgress
            if p["numInputRows"]]
    return spark.createDataFrame(seen, "batch_id long, rows_in long, observed long")


def _rolling_store(spark, sf_dir):
    """The rolling counts as a store merged on reading, fed by several
    micro-batches, each delivered twice."""
    path = _folder(spark, "stream-merge")
    store = jobs.rolling_store(spark, f"{path}/store", buckets=8, max_deltas=3)
    rows = cl.json_key_filter(_event_feed(spark, sf_dir, path), "projectName", fields={"ts_ms": ("date", "bigint")})
    timed = rows.select("projectName", F.timestamp_millis(F.coalesce("ts_ms", F.lit(0).cast("long"))).alias("event_time"))
    counts = win.window_count(timed.withWatermark("event_time", forms.DEFAULT_LAG), ["projectName"], length=SECOND)
    upd = counts.select("projectName", F.col("n").alias("count"), F.col("window_end").alias("updated_at"))

    def twice(batch, batch_id):
        store.upsert(batch, batch_id)
        store.upsert(batch, batch_id)       # as a replayed batch

    _run(upd.writeStream.outputMode("append").foreachBatch(twice), path)
    return store


def stream_merge_store(spark, sf_dir):
    """The store read whole."""
    return _rolling_store(spark, sf_dir).read().withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


def store_lookup_projects(spark, sf_dir):
    """The reference's request strings; only their buckets are opened."""
    req = lk.request_tokens(request_strings(spark, PROJECT_REQUESTS), key_col="arg")
    out = jobs.store_lookup(req, _rolling_store(spark, sf_dir), "arg")
    return out.select("request_id", "pos", F.col("arg").alias("projectName"), "count")


def store_lookup_words(spark, sf_dir):
    """The running word counts of several micro-batches upserted into
    a store merged on reading, and all request tokens answered from it."""
    path = _folder(spark, "word-store")
    store = KeyedStore(spark, f"{path}/store", ("word",), ("count",), "batch", buckets=16, max_deltas=3,
                       schema="word string, count long, batch long")
    counts = forms.running_word_count(_word_feed(spark, sf_dir, path), "text", wc.SPACE)
    _run(counts.writeStream.outputMode("update").foreachBatch(
        lambda b, i: store.upsert(b.withColumn("batch", F.lit(i).cast("long")), i)), path)
    return jobs.store_lookup(_request_tokens(spark, sf_dir), store, "word", on_miss=lk.ZERO)


def _word_set(spark, sf_dir):
    """The running word counts of several micro-batches as a sorted set."""
    path = _folder(spark, "word-set")
    ranking = SortedSet(spark, f"{path}/set", "word", "count", range_rows=10_000, buckets=8)
    counts = forms.running_word_count(_word_feed(spark, sf_dir, path), "text", wc.SPACE)
    _run(counts.writeStream.outputMode("update").foreachBatch(ranking.update), path)
    return ranking


def ranking_updates(spark, sf_dir):
    """K6 O2: the first page of the set after all updates."""
    return _word_set(spark, sf_dir).page(1, TOP_WORDS)


def ranking_of_requests(spark, sf_dir):
    """The rank of every word that the requests name."""
    words = _request_tokens(spark, sf_dir).select("word")
    return _word_set(spark, sf_dir).ranks(words)


# -- windows that move, answers in time, refused documents --------------------------

def sliding_changes(spark, sf_dir):
    """T5: rows of one-hour windows every 15 min, per class: all, new and
    expired since the activation before."""
    return panes.window_changes(_parsed(spark, sf_dir), ["class_name"], length=3600, slide=900)


def sliding_by_name(spark, sf_dir):
    """Counts by project, class and method in sliding windows."""
    return win.counts_by_name(_parsed(spark, sf_dir), length="10 minutes", slide="4 minutes")


def as_of_lookup(spark, sf_dir):
    """The error messages as timed requests, each answered with its
    project's count per minute as it stood at that time."""
    rows = _parsed(spark, sf_dir)
    counts = win.window_count(rows, ["project_name"], length=MINUTE).select(
        "project_name", F.col("window_end").alias("event_time"), "n")
    asked = rows.where(F.col("class_name") == "com.x.error").select("msg_id", "project_name", "event_time")
    return as_of(asked, counts, "project_name", "event_time", ("n",))


def _indexed(spark, sf_dir):
    """The messages that can fail as documents, written or refused."""
    path = _folder(spark, "documents")
    parsed = cl.parse_call_log(_mixed(spark, sf_dir), mode=cl.STRICT).drop("output_info")
    docs = to_documents(parsed, "event_time", stamp_write_time=False)
    for _ in range(2):          # the second time as a replayed batch
        write_or_refuse(docs, f"{path}/out", f"{path}/refused", 0, required={"msg_id": "no id", "class_name": "no class"})
    return path


def index_written(spark, sf_dir):
    """K1: the documents that were indexed."""
    docs = spark.read.schema("msg_id string, project_name string, class_name string, method_name string, ts_ms long, "
                             "_type string, _index string, batch_id long").json(f"{_indexed(spark, sf_dir)}/out")
    return docs.drop("batch_id")


def index_refused(spark, sf_dir):
    """K1: the documents that were refused, with the reason and the batch."""
    rows = spark.read.parquet(f"{_indexed(spark, sf_dir)}/refused")
    field = lambda c: F.get_json_object("document", f"$.{c}").alias(c)
    return rows.select(field("msg_id"), field("project_name"), field("class_name"), field("_index"), "reason",
                       F.col("batch_id").cast("long").alias("batch_id"))
