"""Window assignment against a Python model on generated rows."""

import datetime as dt
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyflow.operators import windows as win

BASE = dt.datetime(2024, 1, 1)
ROWS = st.lists(st.tuples(st.integers(0, 59), st.sampled_from(["a", "b", None])),
                min_size=1, max_size=30)


def windows_of(sec, length, slide):
    """Every window [s, s + length) with s a multiple of the slide that holds sec."""
    return [s for s in range(sec - length + 1, sec + 1) if s % slide == 0 and s <= sec < s + length]


def model(rows, length, slide, new_rows):
    out = Counter()
    for sec, k in rows:
        for s in windows_of(sec, length, slide or length):
            if not new_rows or sec >= s + length - slide:
                out[(s, k)] += 1
    return dict(out)


@settings(max_examples=12, deadline=None)
@given(ROWS, st.integers(2, 20).flatmap(lambda n: st.tuples(st.just(n), st.integers(1, n))))
def test_window_counts_match_model(spark, rows, size):
    length, step = size
    df = spark.createDataFrame([(BASE + dt.timedelta(seconds=s), k) for s, k in rows],
                               "event_time timestamp_ntz, k string")
    for slide, rows_mode in ((None, win.ALL), (step, win.ALL), (step, win.NEW)):
        got = {(int((r.window_start - BASE).total_seconds()), r.k): r.n for r in win.window_count(
            df, ["k"], length=f"{length} seconds", slide=f"{slide} seconds" if slide else None,
            rows=rows_mode).collect()}
        # window starts count from the epoch, of which BASE is a multiple of the slide only by luck
        shift = int((BASE - dt.datetime(1970, 1, 1)).total_seconds())
        want = {(s - shift, k): n for (s, k), n in model(
            [(sec + shift, k) for sec, k in rows], length, slide, rows_mode == win.NEW).items()}
        assert got == want, (length, slide, rows_mode)
