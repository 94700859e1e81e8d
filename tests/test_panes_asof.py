"""T2 / T5 by panes and J3 as of a time: against plain models, and the plans."""

import datetime as dt
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyflow.operators import panes
from tallyflow.operators import windows as win
from tallyflow.operators.asof import as_of

EPOCH = dt.datetime(1970, 1, 1)


def moment(seconds):
    return EPOCH + dt.timedelta(seconds=seconds)


def events(spark, rows):
    return spark.createDataFrame([(None if s is None else moment(s), k) for s, k in rows], "event_time timestamp_ntz, k string")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-40, 80)), st.sampled_from(["a", "b", None])), min_size=1, max_size=25),
       st.integers(1, 20), st.integers(1, 20))
def test_changes_against_model(spark, rows, length, slide):
    """All, new and expired rows of every activation, for slides shorter and
    longer than the window; the three add up from one activation to the next."""
    want = {}
    for s in range(-40 - 2 * (length + slide), 80 + 2 * (length + slide)):
        if s % slide == 0:
            for k in ("a", "b", None):
                now = [t for t, x in rows if x == k and t is not None and s <= t < s + length]
                old = [t for t, x in rows if x == k and t is not None and s - slide <= t < s - slide + length]
                came = [t for t in now if not s - slide <= t < s - slide + length]
                gone = [t for t in old if not s <= t < s + length]
                if now or gone:
                    want[s, k] = (len(now), len(came), len(gone))
                assert len(now) == len(old) + len(came) - len(gone)
    got = {(int((r.window_start - EPOCH).total_seconds()), r.k): (r.n_all, r.n_new, r.n_expired)
           for r in panes.window_changes(events(spark, rows), ["k"], length=length, slide=slide).collect()}
    assert got == want


def test_no_row_is_copied_before_the_first_aggregate(spark):
    """Every sliding count of a batch: from the scan to the first aggregate
    neither a generator nor an expand (grouping sets alone expand by key)."""
    df = spark.range(100).select(F.timestamp_seconds("id").cast("timestamp_ntz").alias("event_time"),
                                 *[F.col("id").cast("string").alias(c) for c in ("k", *win.NAME_LABELS, "return_code")])
    size = {"length": "1 hour", "slide": "7 minutes"}
    for out in (win.window_count(df, ["k"], **size), win.window_groups(df, **size), win.window_groups(df, rows=win.NEW, **size),
                win.conditional_counts(df, **size), panes.window_changes(df, ["k"])):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.splitlines()
        below = lines[max(i for i, x in enumerate(lines) if "Aggregate" in x):]
        assert not any("Generate" in x or "Expand" in x for x in below), plan
        assert any("Generate" in x for x in lines)
    # the same counts as Spark's own overlapping windows
    own = df.groupBy(F.window("event_time", "1 hour", "7 minutes").alias("w"), "k").count()
    assert {(r.w.start, r.k): r["count"] for r in own.collect()} == {
        (r.window_start, r.k): r.n for r in win.window_count(df, ["k"], **size).collect()}


def _as_of(spark, asked, known):
    req = spark.createDataFrame([(i, k, None if t is None else moment(t), -1) for i, (k, t) in enumerate(asked)],
                                "id long, key string, event_time timestamp_ntz, n long")
    hist = spark.createDataFrame([(k, None if t is None else moment(t), n) for k, t, n in known],
                                 "key string, event_time timestamp_ntz, n long")
    return as_of(req, hist)


def _model(asked, known):
    out = {}
    for i, (k, t) in enumerate(asked):
        found = max(((x, n is not None, n or 0) for y, x, n in known if k is not None and t is not None and y == k
                     and x is not None and x <= t), default=None)
        out[i] = (found[2] if found[1] else None, moment(found[0])) if found else (None, None)
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(0, 30))), min_size=1, max_size=30),
       st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 30)), st.one_of(st.none(), st.integers(0, 5))),
                max_size=20))
def test_as_of_against_model(spark, asked, known):
    got = {r.id: (r.n, r.updated_at) for r in _as_of(spark, asked, known).collect()}
    assert got == _model(asked, known)


@pytest.mark.parametrize("every", [1, 400])
def test_as_of_hot_key_is_spread(spark, every):
    """One key with nearly all rows, its history dense or in a few places only:
    the laid-out rows of the key lie in several partitions, and what one hands
    on reaches over partitions without history."""
    rnd = random.Random(every)
    asked = [("hot", rnd.randrange(4000)) for _ in range(2000)] + [("cold", 5), ("hotter", 7)]
    known = [("hot", t, t) for t in range(0, 4000, every)] + [("cold", 9, 9)]
    out = _as_of(spark, asked, known)
    got = {r.id: (r.n, r.updated_at) for r in out.collect()}
    assert got == _model(asked, known)
    files = out.inputFiles()
    parts = Counter()
    for f in set(files):
        parts.update({f: spark.read.parquet(f).where("_k = 'hot'").count()})
    assert sum(n > 0 for n in parts.values()) >= 3 and max(parts.values()) < 0.5 * sum(parts.values())
