"""A4 on streams in two levels: a hot key is cut to one row a task before its
state, and nothing changes in the result."""

import random

from pyspark.sql import functions as F

from tallyflow.streaming import state as ss


def test_hot_key_is_spread_and_nothing_is_lost(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [("hot" if i % 3 == 0 else f"k{rnd.randrange(40)}" if i % 50 else None, rnd.choice([None, rnd.randrange(9)]),
             rnd.choice([None, rnd.randrange(200)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, n long, o long").coalesce(1)
    best = {}
    for k, n, o in rows:
        if o is not None:
            best[k] = max(best.get(k, (-1, False, 0)), (o, n is not None, n or 0))
    want = {k: (o, n if some else None) for k, (o, some, n) in best.items()}
    for salts, keys in ((None, 100_000), (6, 100_000), (6, 5)):
        monkeypatch.setattr(ss, "PARTIAL_KEYS", keys)
        out = ss.partial_latest(df, "k", "n", "o", salts).withColumn("part", F.spark_partition_id()).collect()
        hot = [r.part for r in out if r.k == "hot"]
        assert (len(set(hot)) > 2) == (salts is not None)       # one piece of the source: spread by salts alone
        if keys > 5:
            assert len(out) <= 42 * (salts or 1) and len(hot) <= (salts or 1)
        got = {}
        for r in out:
            got[r.k] = max(got.get(r.k, (-1, False, 0)), (r.o, r.n is not None, r.n or 0))
        assert {k: (o, n if some else None) for k, (o, some, n) in got.items()} == want
    assert ss.partial_latest(df.where("false"), "k", "n", "o", 3).collect() == []
