"""Stream forms: T1-T13, K2, K7/K8, S5 (FIXTURES.md D, F; SURVEY 5 items 3-4).

Every stream reads staged files with ``availableNow`` (one file per
micro-batch), so runs are deterministic.
"""

import datetime as dt
import json
import os
import random
import time

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tallyflow.operators import calllog as cl
from tallyflow.operators import lookup as lk
from tallyflow.operators import windows as win
from tallyflow.plans import catalog, jobs
from tallyflow.sinks.snapshot import KeyedSnapshot
from tallyflow.sources.streams import StreamSpec, read_stream
from tallyflow.streaming import forms
from tallyflow.streaming.state import latest_with_ttl_stream, read_state

from conftest import CALL_LOG_D, SENTENCES, call_log_json
from oracle_compare import compare

AVAILABLE_NOW = {"availableNow": True}
EVENTS = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()),
                    ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string())])


_MTIME = [time.time() - 3600]


def _stage(folder, name, lines):
    """Write one input file; mtimes increase so the file source reads the
    files in staging order (it orders by modification time)."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    _MTIME[0] += 10
    os.utime(path, (_MTIME[0], _MTIME[0]))


def _run(writer):
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


SENTINEL = call_log_json("S", 400_000, "px", "class z.Z", "mz")


def _roll_up(spark, parsed, ck, length="10 seconds", slide=None, rows=win.ALL):
    """The rows that the roll-up stream's sink gets."""
    got = []
    forms.roll_up_closed_windows(forms.hierarchical_groups(parsed, length, slide, rows),
                                 lambda df, i: got.extend(df.collect()), ck, AVAILABLE_NOW).awaitTermination()
    return got


def test_hierarchical_stream_equals_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    for i, chunk in enumerate([CALL_LOG_D[:3], CALL_LOG_D[3:], [SENTINEL]]):
        _stage(src, f"b{i}.txt", chunk)
    msgs = read_stream(spark, StreamSpec(path=src, max_files_per_trigger=1))
    stream = {(r.window_start, r.project_name, r.class_name, r.method_name, r.total_count, r.timestamp)
              for r in _roll_up(spark, forms.parsed_with_watermark(msgs), os.path.join(scratch, "ck"))}
    batch_in = spark.createDataFrame([(v,) for v in CALL_LOG_D], "value string")
    batch = win.hierarchical_count(cl.parse_call_log(batch_in, time_type="timestamp"),
                                   length="10 seconds")
    expect = {(r.window_start, r.project_name, r.class_name, r.method_name, r.total_count, r.timestamp)
              for r in batch.collect()}
    assert stream == expect and len(expect) == 4


def test_late_rows_dropped(spark, scratch):
    src = os.path.join(scratch, "in")
    base = dt.datetime(2024, 1, 1)
    batches = [[(0, "a"), (3, "b"), (9, "a")], [(30, "a"), (31, "a")], [(40, "x")],
               [(5, "late")], [(400, "sentinel")]]
    for i, b in enumerate(batches):
        _stage(src, f"b{i}.json", [json.dumps({"ts": (base + dt.timedelta(seconds=s)).isoformat() + "Z",
                                               "k": k}) for s, k in b])
    spec = StreamSpec(path=src, file_format="json", schema="ts timestamp, k string",
                      max_files_per_trigger=1)
    df = read_stream(spark, spec).withWatermark("ts", "5 seconds")
    counts = win.window_count(df, ["k"], time_col="ts", length="10 seconds")
    q = _run(counts.writeStream.outputMode("append").format("memory").queryName("late_s")
             .option("checkpointLocation", os.path.join(scratch, "ck")))
    got = {(r.window_start.second + 60 * r.window_start.minute, r.k): r.n
           for r in spark.table("late_s").collect()}
    assert got == {(0, "a"): 2, (0, "b"): 1, (30, "a"): 2, (40, "x"): 1}
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress if p.get("stateOperators"))
    assert dropped == 1


def test_word_count_restart_and_state_reader(spark, scratch):
    src, ck = os.path.join(scratch, "in"), os.path.join(scratch, "ck")
    _stage(src, "a.txt", SENTENCES[:3])
    spec = StreamSpec(path=src, max_files_per_trigger=1)
    seen = []
    sink = lambda b, i: seen.append({r.word: r["count"] for r in b.collect()})
    q = jobs.word_count_stream(spark, spec, ck, "update", trigger=AVAILABLE_NOW, foreach_batch=sink)
    q.awaitTermination()
    _stage(src, "b.txt", SENTENCES[3:])
    n_first = len(seen)
    q = jobs.word_count_stream(spark, spec, ck, "update", trigger=AVAILABLE_NOW, foreach_batch=sink)
    q.awaitTermination()
    # the second run read only the new file, and the state carried on (update mode)
    second = {k: v for b in seen[n_first:] for k, v in b.items()}
    assert second["the"] == 4 and "cow" not in second
    state = read_state(spark, ck)
    counts = {r.key.word: r.value["count"] for r in state.collect()}
    assert counts["the"] == 4 and counts["seven"] == 2 and len(counts) == 27


def test_rolling_stream_snapshot_and_lookup(spark, scratch):
    src = os.path.join(scratch, "in")
    for i, chunk in enumerate([CALL_LOG_D[:3], CALL_LOG_D[3:], [SENTINEL]]):
        _stage(src, f"b{i}.txt", chunk)
    snap = KeyedSnapshot(spark, os.path.join(scratch, "snap"), ("projectName",), ("count",),
                         "updated_at")
    q = jobs.rolling_stream(spark, StreamSpec(path=src, max_files_per_trigger=1), snap,
                            os.path.join(scratch, "ck"), length="10 seconds",
                            trigger=AVAILABLE_NOW)
    q.awaitTermination()
    state = {r.projectName: r["count"] for r in snap.read().collect()}
    assert state == {"p1": 1, "p2": 1}
    # the request stream is answered from the store, micro-batch by micro-batch
    req_dir = os.path.join(scratch, "req")
    _stage(req_dir, "r.json", [json.dumps({"request_id": 7, "args": "p1 zz p2"})])
    reqs = spark.readStream.schema("request_id long, args string").json(req_dir)
    ans = []
    jobs.rolling_lookup_stream(spark, reqs, snap, lambda df, i: ans.extend(df.collect()),
                               os.path.join(scratch, "ck2"), lk.NULL, AVAILABLE_NOW).awaitTermination()
    got = sorted((r.pos, r.projectName, r["count"]) for r in ans)
    assert got == [(0, "p1", "1"), (1, "zz", None), (2, "p2", "1")]


def test_log_rollup_stream_writes_daily_index(spark, scratch):
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "docs")
    for i, chunk in enumerate([CALL_LOG_D, [SENTINEL]]):
        _stage(src, f"b{i}.txt", chunk)
    q = jobs.log_rollup_stream(spark, StreamSpec(path=src, max_files_per_trigger=1), out,
                               os.path.join(scratch, "ck"), trigger=AVAILABLE_NOW)
    q.awaitTermination()
    docs = spark.read.json(out)
    assert {r._index for r in docs.select("_index").collect()} == {"logcount-2024.01.01"}
    assert docs.count() == 4 and os.path.isdir(os.path.join(out, "_index=logcount-2024.01.01"))


def test_observe_rows(spark, scratch):
    src = os.path.join(scratch, "in")
    _stage(src, "a.txt", SENTENCES)
    lines = forms.observe_rows(read_stream(spark, StreamSpec(path=src)), "lines_seen")
    q = _run(lines.writeStream.format("noop").option("checkpointLocation", os.path.join(scratch, "ck")))
    seen = [p["observedMetrics"]["lines_seen"]["rows"] for p in q.recentProgress
            if p.get("observedMetrics")]
    assert sum(seen) == 5


def test_latest_with_ttl_expires(spark, scratch):
    src, ck = os.path.join(scratch, "in"), os.path.join(scratch, "ck")
    spec_schema = "k string, n long, updated_at timestamp"
    out = []

    def run(expected):
        # processing-time state keeps scheduling no-data batches (for expiry),
        # so neither availableNow nor processAllAvailable ends: poll, then stop
        df = spark.readStream.schema(spec_schema).json(src)
        q = (latest_with_ttl_stream(df, "k", ttl_seconds=2).writeStream.outputMode("update")
             .foreachBatch(lambda b, i: out.extend(tuple(r) for r in b.collect()))
             .option("checkpointLocation", ck).start())
        deadline = time.time() + 90
        while len(out) < expected and time.time() < deadline and q.exception() is None:
            time.sleep(0.5)
        q.stop()

    _stage(src, "a.json", [json.dumps({"k": "a", "n": 5, "updated_at": "2024-01-01T00:00:10Z"})])
    run(1)
    time.sleep(4)  # longer than the 2 s TTL (processing time)
    _stage(src, "b.json", [json.dumps({"k": "a", "n": 3, "updated_at": "2024-01-01T00:00:05Z"})])
    run(2)
    # the first value had expired, so the older second row becomes the latest
    assert [(k, n) for k, n, _ in out] == [("a", 5), ("a", 3)]


def test_stream_equals_batch_on_driver_events(spark, scratch):
    """SURVEY 5 item 3 on the sf0.001 events: the messages in 4 files (time
    order), plus a far-future sentinel; the stream roll-up equals the batch
    roll-up for every window."""
    from tallyflow.sources import adapters
    from tallyflow.sources.tables import table
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        import pytest
        pytest.skip("driver tables not present")
    ev = table(spark, sf, "events")
    msgs = adapters.call_log_messages(ev.orderBy("ts")).collect()
    src = os.path.join(scratch, "in")
    q4 = (len(msgs) + 3) // 4
    for i in range(4):
        _stage(src, f"b{i}.txt", [m.value for m in msgs[i * q4:(i + 1) * q4]])
    _stage(src, "b9.txt", [call_log_json("S", 10 ** 11, "px", "class z.Z", "mz")])
    parsed = forms.parsed_with_watermark(read_stream(spark, StreamSpec(path=src, max_files_per_trigger=1)))
    stream = {(r.window_start, r.project_name, r.class_name, r.method_name, r.total_count, r.timestamp)
              for r in _roll_up(spark, parsed, os.path.join(scratch, "ck"), "1 hour") if r.project_name != "px"}
    batch = win.hierarchical_count(cl.parse_call_log(adapters.call_log_messages(ev), time_type="timestamp"),
                                   length="1 hour")
    expect = {tuple(r) for r in batch.select("window_start", "project_name", "class_name",
                                             "method_name", "total_count", "timestamp").collect()}
    assert stream == expect and len(expect) > 500


def _stream_rows(spark, scratch, name, build):
    src = os.path.join(scratch, "in-" + name)
    for i, chunk in enumerate([CALL_LOG_D[:3], CALL_LOG_D[3:], [SENTINEL]]):
        _stage(src, f"b{i}.txt", chunk)
    parsed = forms.parsed_with_watermark(read_stream(spark, StreamSpec(path=src, max_files_per_trigger=1)))
    _run(build(parsed).writeStream.outputMode("append").format("memory").queryName(name)
         .option("checkpointLocation", os.path.join(scratch, "ck-" + name)))
    return spark.table(name)


def _batch_parsed(spark):
    df = spark.createDataFrame([(v,) for v in CALL_LOG_D], "value string")
    return cl.parse_call_log(df, time_type="timestamp")


def _rows(df, cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_window_operators_stream_equal_batch(spark, scratch):
    """counts_by_name (GROUPING SETS), conditional counts and sliding windows
    ("all" and "new" rows) give the batch result on a stream; the sentinel's
    own window is still open and not emitted."""
    b = _batch_parsed(spark)
    cols = ["window_start", "window_end", "name", "key", "n"]
    s = _stream_rows(spark, scratch, "byname_s", lambda p: win.counts_by_name(p, length="10 seconds"))
    assert _rows(s, cols) == _rows(win.counts_by_name(b, length="10 seconds"), cols)
    cols = ["window_start", "window_end", "metric", "n", "timestamp"]
    s = _stream_rows(spark, scratch, "cond_s", lambda p: win.conditional_counts(
        cl.result_codes(p), length="10 seconds"))
    assert _rows(s, cols) == _rows(win.conditional_counts(cl.result_codes(b), length="10 seconds"), cols)
    cols = ["window_start", "window_end", "class_name", "n"]
    for rows in (win.ALL, win.NEW):
        name = f"slide_{rows}_s"
        s = _stream_rows(spark, scratch, name, lambda p: win.window_count(
            p, ["class_name"], length="10 seconds", slide="5 seconds", rows=rows))
        expect = _rows(win.window_count(b, ["class_name"], length="10 seconds", slide="5 seconds",
                                        rows=rows), cols)
        assert _rows(s, cols) == expect and len(expect) >= 3


def _parsed_stream(spark, scratch, name):
    src = os.path.join(scratch, "in-" + name)
    for i, chunk in enumerate([CALL_LOG_D[:3], CALL_LOG_D[3:], [SENTINEL]]):
        _stage(src, f"b{i}.txt", chunk)
    return forms.parsed_with_watermark(read_stream(spark, StreamSpec(path=src, max_files_per_trigger=1)))


def test_hierarchical_stream_sliding(spark, scratch):
    """All and new rows, with slides that divide the length and that do not."""
    b = _batch_parsed(spark)
    cols = ["window_start", "window_end", "project_name", "class_name", "method_name", "total_count", "timestamp"]
    for length, slide in (("10 seconds", "5 seconds"), ("10 seconds", "4 seconds"), ("10 seconds", "3 seconds"),
                          ("1 minute", "25 seconds")):
        for rows in (win.ALL, win.NEW):
            name = f"{length}-{slide}-{rows}"
            got = _roll_up(spark, _parsed_stream(spark, scratch, name), os.path.join(scratch, "ck-" + name),
                           length, slide, rows)
            expect = _rows(win.hierarchical_count(b, length=length, slide=slide, rows=rows), cols)
            assert {tuple(r[c] for c in cols) for r in got} == expect and len(expect) >= 4, name


def test_word_lookup_against_live_state(spark, scratch):
    """J-DRPC stream form: the word-count stream keeps its state; a request
    stream is answered from the state it last committed."""
    src, ck = os.path.join(scratch, "in"), os.path.join(scratch, "wc-ck")
    _stage(src, "a.txt", SENTENCES)
    q = jobs.word_count_stream(spark, StreamSpec(path=src), ck, "update", trigger=AVAILABLE_NOW,
                               foreach_batch=lambda b, i: b.write.format("noop").mode("overwrite").save(),
                               mode="space")
    q.awaitTermination()
    req_dir = os.path.join(scratch, "req")
    _stage(req_dir, "r.json", [json.dumps({"request_id": 1, "args": "the and apple snow jumped"}),
                               json.dumps({"request_id": 2, "args": "kafka"})])
    reqs = spark.readStream.schema("request_id long, args string").json(req_dir)
    got = []
    q = jobs.word_lookup_stream(spark, reqs, ck, lambda df, i: got.extend(
        (r.request_id, r.word, r["count"]) for r in df.collect()),
        os.path.join(scratch, "req-ck"), trigger=AVAILABLE_NOW)
    q.awaitTermination()
    assert sorted(got) == sorted([(1, "the", 4), (1, "and", 2), (1, "apple", 1), (1, "snow", 1),
                                  (1, "jumped", 1)])


def test_topic_records_stream(spark, scratch):
    """J-KTEST producer as a stream: each sentence becomes a record with a
    null key (K4), written exactly once through the file sink log."""
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "records")
    _stage(src, "a.txt", SENTENCES[:2])
    _stage(src, "b.txt", SENTENCES[2:])
    lines = read_stream(spark, StreamSpec(path=src, max_files_per_trigger=1))
    q = jobs.topic_records_stream(jobs.sentence_records(lines, "value"), spark, out,
                                  os.path.join(scratch, "ck"), trigger=AVAILABLE_NOW)
    q.awaitTermination()
    back = spark.read.schema("key string, value string").json(out)
    assert sorted(r.value for r in back.collect()) == sorted(SENTENCES)
    assert back.where("key IS NOT NULL").count() == 0


def test_top_n_closed_windows_for_free_text(spark, scratch):
    """Top-2 words per 10 s window of a text stream, computed per micro-batch
    on closed windows (no per-window list of all words in state)."""
    src = os.path.join(scratch, "in")
    base = dt.datetime(2024, 1, 1)
    rows = [(0, "the cow the moon"), (3, "the apple a day"), (12, "snow and the seven"),
            (14, "seven years seven"), (400, "sentinel")]
    for i, (sec, text) in enumerate(rows):
        _stage(src, f"b{i}.json", [json.dumps({"ts": (base + dt.timedelta(seconds=sec)).isoformat() + "Z",
                                               "line": text})])
    spec = StreamSpec(path=src, file_format="json", schema="ts timestamp, line string",
                      max_files_per_trigger=1)
    from tallyflow.operators import wordcount as wc
    toks = wc.tokens(read_stream(spark, spec).withWatermark("ts", "5 seconds"), "line",
                     keep=("ts",))
    counts = win.window_count(toks, ["word"], time_col="ts", length="10 seconds")
    got = []
    q = forms.top_n_closed_windows(counts, 2, "word", lambda df, i: got.extend(
        (r.window_start.second, r.word, r.n, r.rank) for r in df.collect()),
        os.path.join(scratch, "ck"), trigger=AVAILABLE_NOW)
    q.awaitTermination()
    assert sorted(got) == sorted([(0, "the", 3, 1), (0, "a", 1, 2), (10, "seven", 3, 1), (10, "and", 1, 2)])


def test_log_rollup_stream_bounded_files(spark, scratch):
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "docs")
    for i, chunk in enumerate([CALL_LOG_D, [SENTINEL]]):
        _stage(src, f"b{i}.txt", chunk)
    q = jobs.log_rollup_stream(spark, StreamSpec(path=src, max_files_per_trigger=1), out,
                               os.path.join(scratch, "ck"), trigger=AVAILABLE_NOW, output_files=1)
    q.awaitTermination()
    day = os.path.join(out, "_index=logcount-2024.01.01")
    files = [[f for f in os.listdir(os.path.join(day, b)) if f.startswith("part-")] for b in os.listdir(day)
             if b.startswith("batch_id=")]
    assert files and all(len(f) == 1 for f in files) and spark.read.json(out).count() == 4


def test_word_count_complete_listing_equals_batch(spark, scratch):
    """K7: the complete-mode listing after the last batch is the batch count."""
    src = os.path.join(scratch, "in")
    _stage(src, "a.txt", SENTENCES[:2])
    _stage(src, "b.txt", SENTENCES[2:])
    listing = []
    q = jobs.word_count_stream(spark, StreamSpec(path=src, max_files_per_trigger=1),
                               os.path.join(scratch, "ck"), "complete", trigger=AVAILABLE_NOW,
                               foreach_batch=lambda b, i: listing.append(b.collect()))
    q.awaitTermination()
    stream = {r.word: r["count"] for r in listing[-1]}
    batch_in = spark.createDataFrame([(s,) for s in SENTENCES], "line string")
    assert stream == {r.word: r["count"] for r in jobs.word_count_batch(batch_in).collect()}


def test_rate_limits(spark, scratch):
    """Files and bytes per trigger bound each micro-batch."""
    src = os.path.join(scratch, "in")
    for i in range(4):
        _stage(src, f"f{i}.txt", ["x" * 1000])
    for name, spec in (("bytes", StreamSpec(path=src, max_bytes_per_trigger="1500")),
                       ("files", StreamSpec(path=src, max_files_per_trigger=2)),
                       ("none", StreamSpec(path=src))):
        q = _run(read_stream(spark, spec).writeStream.format("noop")
                 .option("checkpointLocation", os.path.join(scratch, "ck-" + name)))
        batches = sum(1 for p in q.recentProgress if p["numInputRows"] > 0)
        assert batches == {"bytes": 4, "files": 2, "none": 1}[name], (name, batches)


def test_window_total_and_last_key_stream_equal_batch(spark, scratch):
    b = _batch_parsed(spark)
    cols = ["window_start", "window_end", "n"]
    s = _stream_rows(spark, scratch, "total_s", lambda p: win.window_total(p, length="10 seconds"))
    assert _rows(s, cols) == _rows(win.window_total(b, length="10 seconds"), cols)
    cols = ["window_start", "window_end", "project_name", "n"]
    s = _stream_rows(spark, scratch, "last_s", lambda p: win.window_last_key(
        p, "project_name", length="10 seconds"))
    expect = _rows(win.window_last_key(b, "project_name", length="10 seconds"), cols)
    assert _rows(s, cols) == expect and len(expect) == 2


def test_log_rollup_restart_exactly_once(spark, scratch):
    """Stop after the first files, add more, restart from the checkpoint:
    every closed window's documents are written once (file sink log)."""
    src, out, ck = (os.path.join(scratch, d) for d in ("in", "docs", "ck"))
    spec = StreamSpec(path=src, max_files_per_trigger=1)
    cols = ["project_name", "class_name", "method_name", "total_count"]
    _stage(src, "b0.txt", CALL_LOG_D[:3])
    _stage(src, "b1.txt", CALL_LOG_D[3:] + [call_log_json("L9", 20_000, "p9", "class q.Q", "m9")])
    jobs.log_rollup_stream(spark, spec, out, ck, trigger=AVAILABLE_NOW).awaitTermination()
    first = sorted(tuple(r) for r in spark.read.json(out).select(*cols).collect())
    assert first == sorted([("p1", "a.B", "m1", 3), ("p1", "a.B", "m2", 1), ("p2", "c.D", "m1", 1)])
    _stage(src, "b2.txt", [SENTINEL])
    jobs.log_rollup_stream(spark, spec, out, ck, trigger=AVAILABLE_NOW).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.json(out).select(*cols).collect())
    assert got == sorted(first + [("p1", "a.B", "m1", 1), ("p9", "q.Q", "m9", 1)])


def test_route_stream_writes_named_branches(spark, scratch):
    """General and status branches from one parse per micro-batch."""
    src = os.path.join(scratch, "in")
    _stage(src, "a.txt", CALL_LOG_D[:3])
    _stage(src, "b.txt", CALL_LOG_D[3:])
    outs = {n: os.path.join(scratch, n) for n in ("general", "status")}
    sinks = {n: (lambda p: lambda df, i: df.write.mode("append").parquet(p))(outs[n]) for n in outs}
    q = forms.route_stream(read_stream(spark, StreamSpec(path=src, max_files_per_trigger=1)), sinks,
                           os.path.join(scratch, "ck"), trigger=AVAILABLE_NOW)
    q.awaitTermination()
    assert spark.read.parquet(outs["general"]).count() == 6
    status = sorted(r.msg_id for r in spark.read.parquet(outs["status"]).collect())
    assert status == ["L1", "L2", "L6"]


@pytest.fixture(scope="module")
def shuffled_events(tmp_path_factory):
    """Events in 2200 files finished in shuffled order, three micro-batches of
    1000 files. (The second would still count late rows, as Spark drops rows
    by the watermark of the micro-batch before.)"""
    top = tmp_path_factory.mktemp("shuffled")
    folder = top / "events.parquet"
    folder.mkdir()
    order = list(range(2200))
    random.Random(3).shuffle(order)
    t0 = dt.datetime(2024, 1, 1)
    for k, i in enumerate(order):
        row = {"event_id": [i], "ts": [t0 + dt.timedelta(seconds=7 * i)], "user_id": [i % 50],
               "event_type": [("click", "view", "error")[i % 3]], "value": [i / 4], "props": ['{"k": 1}']}
        path = folder / f"part-{i:04d}.parquet"
        pq.write_table(pa.table(row, schema=EVENTS), path)
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    return top


@pytest.mark.parametrize("name", ["stream_log_rollup", "stream_window_rows", "stream_keyed_store"])
def test_registered_event_streams_count_all_rows_of_many_files(spark, shuffled_events, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{shuffled_events}/events.parquet/*.parquet')")
    info = compare(spark, con, name, catalog.QUERIES[name], catalog.oracle_sql()[name], str(shuffled_events))
    assert info["oracle_rows"] > 0 and info["match"], info
