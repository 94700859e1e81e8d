"""A4 + T6: latest value per key and TTL expiry against a dictionary model."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyflow.operators import state as stt

BASE = dt.datetime(2024, 1, 1)
# unique (key, time) pairs: "latest" is then well defined
UPDATES = st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 1000), st.integers(0, 99)),
                   min_size=1, max_size=25, unique_by=lambda u: (u[0], u[1]))


@settings(max_examples=8, deadline=None)
@given(UPDATES, st.integers(1, 600), st.sampled_from([stt.KEY, stt.TABLE]))
def test_latest_and_ttl_match_model(spark, updates, ttl, scope):
    df = spark.createDataFrame([(k, n, BASE + dt.timedelta(seconds=t)) for k, t, n in updates],
                               "k string, n long, t timestamp_ntz")
    latest = stt.latest_per_key(df, "k", "n", "t")
    as_of = F.lit(BASE + dt.timedelta(seconds=1000)).cast("timestamp_ntz")
    writes = df.select(F.col("t").alias("updated_at"))
    live = stt.live_state(latest, "updated_at", ttl, as_of=as_of, scope=scope, writes=writes)
    got = {r.k: (r.n, int((r.updated_at - BASE).total_seconds())) for r in live.collect()}
    best = {}
    for k, t, n in updates:
        if k not in best or t > best[k][1]:
            best[k] = (n, t)
    if scope == stt.KEY:
        want = {k: v for k, v in best.items() if v[1] > 1000 - ttl}
    else:
        times = sorted({t for _, t, _ in updates})
        since = max(t for k, t in enumerate(times) if k == 0 or t - times[k - 1] > ttl)
        want = {k: v for k, v in best.items() if v[1] >= since} if times[-1] > 1000 - ttl else {}
    assert got == want
