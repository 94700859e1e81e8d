"""O1 by a sketch of fixed size: exact against a plain model, and its bounds."""

import datetime as dt
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyflow.operators import rolling

EPOCH = dt.datetime(1970, 1, 1)


def _events(spark, rows):
    return spark.createDataFrame([(None if s is None else EPOCH + dt.timedelta(seconds=s), k) for s, k in rows],
                                 "event_time timestamp_ntz, key string")


def _model(rows, n, length, slide):
    counts = {}
    for s, k in rows:
        if s is not None:
            start = s // slide * slide
            while start + length > s:
                counts.setdefault(start, Counter())[k] += 1
                start -= slide
    return {(w, k): (c, r) for w, of in counts.items()
            for r, (k, c) in enumerate(sorted(of.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:n], 1)}


def _got(df):
    rows = df.collect()
    out = {(int((r.window_start - EPOCH).total_seconds()), r.key): (r.n, r.rank) for r in rows}
    assert len(out) == len(rows)
    return out


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-30, 60)), st.sampled_from(["a", "b", "c", "d", None])),
                min_size=1, max_size=40),
       st.integers(1, 3), st.integers(1, 20), st.integers(1, 12), st.sampled_from([1, 2, 16]))
def test_against_model(spark, rows, n, length, slide, counters):
    got = rolling.rolling_top_n(_events(spark, rows), n, length=length, slide=slide, counters=counters)
    assert _got(got) == _model(rows, n, length, slide)


@pytest.mark.parametrize("limit", [rolling.BROADCAST_SLOTS, 0])
def test_hot_and_many_keys(spark, monkeypatch, limit):
    """A key with a third of the rows, keys that clash in a slot, many ties; with
    and without the broadcast."""
    monkeypatch.setattr(rolling, "BROADCAST_SLOTS", limit)
    rnd = random.Random(3)
    rows = [(rnd.randrange(200), "hot" if rnd.random() < 1 / 3 else f"k{int(rnd.expovariate(0.02))}") for _ in range(4000)]
    got = rolling.rolling_top_n(_events(spark, rows), 5, length=60, slide=20, counters=32)
    assert _got(got) == _model(rows, 5, 60, 20)


def test_more_than_a_thousand(spark):
    rows = [(0, f"k{k}") for k in range(1500) for _ in range(1 + (k < 1200))]
    assert _got(rolling.rolling_top_n(_events(spark, rows), 1100, length=10, slide=10)) == _model(rows, 1100, 10, 10)


def test_bounds_of_the_sketch(spark):
    """At most ``counters`` numbers a pane and window, none below the count of a
    key in its slot, and only the keys of few slots are counted."""
    rnd = random.Random(4)
    rows = [(rnd.randrange(120), f"k{int(rnd.paretovariate(0.6))}") for _ in range(6000)]
    of = rolling.pane_rows(_events(spark, rows), "key", "event_time", 60, 20, 64)
    panes = rolling.sketch(of)
    seen = rolling.merged(panes, 60, 20)
    assert panes.groupBy("_p").count().agg(F.max("count")).first()[0] <= 64
    assert seen.groupBy("_w").count().agg(F.max("count")).first()[0] <= 64
    exact = _model(rows, 10 ** 6, 60, 20)
    most = {(int((r._w.start - EPOCH).total_seconds()), r._slot): r._most for r in seen.collect()}
    slot = {r._k: r._slot for r in of.select("_k", "_slot").distinct().collect()}
    assert all(most[w, slot[k]] >= c for (w, k), (c, _) in exact.items())
    big = seen.where("_most >= 300").select("_w", "_slot")
    counted = rolling.count_slots(of, panes, big, 60, 20).collect()
    want = {(w, k): c for (w, k), (c, _) in exact.items() if most[w, slot[k]] >= 300}
    assert {(int((r._w.start - EPOCH).total_seconds()), r._k): r._n for r in counted} == want
    assert 0 < len(want) < len(exact) / 2


def test_no_rows(spark):
    assert rolling.rolling_top_n(_events(spark, [(None, "a")]), 3).count() == 0
