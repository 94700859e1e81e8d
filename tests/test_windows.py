"""A5-A13, T1/T2/T5, F5/F6, O1, K1 on FIXTURES.md D (10 s windows)."""

import datetime as dt

from tallyflow.operators import calllog as cl
from tallyflow.operators import topn
from tallyflow.operators import windows as win
from tallyflow.sinks.documents import index_documents

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
T10 = dt.datetime(2024, 1, 1, 0, 0, 10)


def _parsed(call_log):
    return cl.parse_call_log(call_log)


def test_hierarchical(call_log):
    rows = win.hierarchical_count(_parsed(call_log), length="10 seconds").collect()
    got = {(r.window_start, r.project_name, r.class_name, r.method_name): (r.total_count, r.timestamp)
           for r in rows}
    assert got == {
        (T0, "p1", "a.B", "m1"): (3, T0), (T0, "p1", "a.B", "m2"): (1, T0),
        (T0, "p2", "c.D", "m1"): (1, T0), (T10, "p1", "a.B", "m1"): (1, T10)}


def test_counts_by_name(call_log):
    rows = win.counts_by_name(_parsed(call_log), length="10 seconds").collect()
    got = {(r.window_start, r.name, r.key): r.n for r in rows}
    assert got == {
        (T0, "project_name", "p1"): 4, (T0, "project_name", "p2"): 1,
        (T0, "class_name", "a.B"): 4, (T0, "class_name", "c.D"): 1,
        (T0, "method_name", "m1"): 4, (T0, "method_name", "m2"): 1,
        (T10, "project_name", "p1"): 1, (T10, "class_name", "a.B"): 1,
        (T10, "method_name", "m1"): 1}


def test_single_key_counts_and_null_group(spark, call_log):
    rows = win.window_count(_parsed(call_log), ["project_name"], length="10 seconds").collect()
    assert {(r.window_start, r.project_name): r.n for r in rows} == {
        (T0, "p1"): 4, (T0, "p2"): 1, (T10, "p1"): 1}
    df = spark.createDataFrame([(None, T0), (None, T0), ("a", T0)], "k string, event_time timestamp_ntz")
    got = {r.k: r.n for r in win.window_count(df, ["k"], length="10 seconds").collect()}
    assert got == {None: 2, "a": 1}


def test_conditional_counts(call_log):
    codes = cl.result_codes(_parsed(call_log))
    rows = win.conditional_counts(codes, length="10 seconds").collect()
    assert {(r.window_start, r.metric): (r.n, r.timestamp) for r in rows} == {
        (T0, "login_success"): (2, T0), (T0, "register_success"): (1, T0)}


def test_window_total_and_last_key(call_log):
    p = _parsed(call_log)
    tot = {r.window_start: r.n for r in win.window_total(p, length="10 seconds").collect()}
    assert tot == {T0: 5, T10: 1}
    last = {r.window_start: (r.project_name, r.n) for r in
            win.window_last_key(p, "project_name", length="10 seconds").collect()}
    assert last == {T0: ("p1", 5), T10: ("p1", 1)}


def test_top1_project(call_log):
    counts = win.window_count(_parsed(call_log), ["project_name"], length="10 seconds")
    top = topn.top_n_per_group(counts, 1, key_col="project_name").collect()
    assert {(r.window_start, r.project_name, r.n, r.rank) for r in top} == {
        (T0, "p1", 4, 1), (T10, "p1", 1, 1)}


def test_rank_top_all_tied_and_large_n(spark):
    """Any number of rows may tie; n over Spark's group-limit threshold."""
    tied = spark.range(20_000).selectExpr("cast(id as string) AS key", "1L AS n")
    got = topn.rank_top(tied.unionByName(spark.createDataFrame([("top", 5), ("none", None)], "key string, n long")), 2)
    assert got.count() == 20_001 and got.where("rank = 1").count() == 1
    many = spark.range(3000).selectExpr("cast(id as string) AS key", "id DIV 2 AS n")
    ranks = {r.key: r.rank for r in topn.rank_top(many, 1501).collect()}
    assert len(ranks) == 1502 and ranks["2999"] == ranks["2998"] == 1 and ranks["1498"] == ranks["1499"] == 1501
    nulls = spark.createDataFrame([("a", 1), ("b", None), ("c", None)], "key string, n long")
    assert {(r.key, r.rank) for r in topn.rank_top(nulls, 3).collect()} == {("a", 1), ("b", 2), ("c", 2)}


def test_store_ranking_replaces(spark, scratch):
    df = spark.createDataFrame([("a", 3), ("b", 2), ("c", 2), ("d", 1)], "key string, n long")
    for n in (9, 2):
        topn.store_ranking(topn.rank_top(df, n), scratch + "/rank")
    assert [tuple(r) for r in spark.read.parquet(scratch + "/rank").collect()] == [(1, "a", 3), (2, "b", 2), (2, "c", 2)]


def test_rank_top_shares_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 3), ("d", 1)], "key string, n long")
    got = {(r.key, r.rank) for r in topn.rank_top(df, 2).collect()}
    assert got == {("a", 1), ("b", 1)}
    got3 = {(r.key, r.rank) for r in topn.rank_top(df, 3).collect()}
    assert got3 == {("a", 1), ("b", 1), ("c", 3)}


def test_sliding_all_vs_new(spark):
    # rows at 5 s, 15 s, 25 s; windows 20 s sliding by 10 s
    ts = [dt.datetime(2024, 1, 1, 0, 0, s) for s in (5, 15, 25)]
    df = spark.createDataFrame([(t,) for t in ts], "event_time timestamp_ntz")
    al = {(r.window_start.second, r.window_end.second): r.n for r in
          win.window_total(df, length="20 seconds", slide="10 seconds", rows=win.ALL).collect()}
    assert al == {(50, 10): 1, (0, 20): 2, (10, 30): 2, (20, 40): 1}
    new = {(r.window_start.second, r.window_end.second): r.n for r in
           win.window_total(df, length="20 seconds", slide="10 seconds", rows=win.NEW).collect()}
    assert new == {(50, 10): 1, (0, 20): 1, (10, 30): 1}


def test_pack_map_and_list_round_trip(spark, call_log):
    p = _parsed(call_log)
    counts = win.counts_by_name(p, length="10 seconds")
    packed = win.pack_map(counts)
    m = {(r.window_start, r.name): r.sum_map for r in packed.collect()}
    assert m[(T0, "class_name")] == {"a.B": 4, "c.D": 1}
    back = {(r.window_start, r.name, r.key, r.n) for r in win.unpack_map(packed).collect()}
    assert back == {(r.window_start, r.name, r.key, r.n) for r in counts.collect()}
    hier = win.hierarchical_count(p, length="10 seconds")
    lst = {r.window_start: r.sum_count_list for r in win.pack_list(hier).collect()}
    assert [x.total_count for x in lst[T0]] == [3, 1, 1]
    assert win.unpack_list(win.pack_list(hier)).count() == 4


def test_pack_map_keeps_null_key(spark):
    df = spark.createDataFrame([(T0, T10, None, 2), (T0, T10, "a", 1)],
                               "window_start timestamp_ntz, window_end timestamp_ntz, key string, n long")
    r = win.pack_map(df, label="class_name").first()
    assert r.sum_map == {"a": 1} and r.null_key_count == 2 and r.name == "class_name"
    assert win.unpack_map(win.pack_map(df, label="x")).count() == 2


def test_index_documents(call_log):
    hier = win.hierarchical_count(_parsed(call_log), length="10 seconds")
    docs = index_documents(hier, "timestamp")
    rows = docs.collect()
    assert {r._index for r in rows} == {"logcount-2024.01.01"}
    assert {r._type for r in rows} == {"info"} and "@timestamp" in docs.columns


def test_conditional_counts_new_rows_first_time(call_log):
    """rows="new" counts the last slide only, but stamps the window's first
    time over all its rows (as the reference's window bolts do)."""
    codes = cl.result_codes(_parsed(call_log))
    rows = win.conditional_counts(codes, length="10 seconds", slide="5 seconds",
                                  rows=win.NEW).collect()
    got = {(r.window_start.second, r.window_end.second, r.metric): (r.n, r.timestamp.second)
           for r in rows}
    # window [0,10): new rows are [5,10) -> no 10000/10002 codes there (L5 has none)
    # window [-5,5): new rows [0,5) -> L1, L3 login, L2 register; first time 0
    assert got == {(55, 5, "login_success"): (2, 0), (55, 5, "register_success"): (1, 0)}
    # discriminating case: in window [0,10) only the 7 s row is new, but the
    # window's first row is at 1 s
    df = spark_rows_codes(call_log.sparkSession, [(1, "10002"), (7, "10000")])
    got = {(r.window_start.second, r.metric): (r.n, r.timestamp.second) for r in
           win.conditional_counts(df, length="10 seconds", slide="5 seconds", rows=win.NEW).collect()}
    assert got[(0, "login_success")] == (1, 1)


def spark_rows_codes(spark, rows):
    return spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, s), c) for s, c in rows],
        "event_time timestamp_ntz, return_code string")
