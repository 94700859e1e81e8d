"""The merge-on-read store against the snapshot, what it
writes and what a look-up opens."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyflow.operators import lookup as lk
from tallyflow.sinks import textfile
from tallyflow.sinks.keyed_store import KeyedStore
from tallyflow.sinks.snapshot import KeyedSnapshot

T0 = dt.datetime(2024, 1, 1)
ROW = "k string, n long, updated_at timestamp"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def rows_of(df):
    return sorted(((r.k, r.n, r.updated_at) for r in df.collect()), key=repr)


def batch(spark, rows):
    return spark.createDataFrame([(k, n, None if o is None else at(o)) for k, n, o in rows], ROW)


@pytest.mark.parametrize("scope", ["key", "table"])
def test_same_as_snapshot(spark, scratch, scope):
    """Random batches with old, equal and null order times, pauses around the
    TTL, empty batches and replays; read between batches at several times."""
    rnd = random.Random(scope)
    store = KeyedStore(spark, f"{scratch}/store", ("k",), ("n",), ttl_seconds=50, ttl_scope=scope,
                       buckets=3, max_deltas=2, growth=1.5)
    snap = KeyedSnapshot(spark, f"{scratch}/snap", ("k",), ("n",), ttl_seconds=50, ttl_scope=scope)
    clock = 0
    folded = 0
    for i in range(9):
        clock += rnd.choice([10, 10, 30, 49, 50, 60])
        rows = [(rnd.choice(["a", "b", "c", None]), rnd.randint(0, 9), rnd.choice([None, 5, clock, clock + 20]))
                for _ in range(0 if i == 4 else rnd.randint(1, 3))]
        for _ in range(2):
            store.upsert(batch(spark, rows), i, at(clock))
        snap.upsert(batch(spark, rows), i, at(clock))
        folded += store.manifest()["base"] is not None
        for later in (0, 49 + i % 2):
            assert rows_of(store.read(at(clock + later))) == rows_of(snap.read(as_of=at(clock + later))), (i, later)
    assert folded


def test_bytes_follow_the_batch(spark, scratch):
    store = KeyedStore(spark, f"{scratch}/s", ("k",), ("n",), buckets=4, max_deltas=4)
    big = spark.range(200_000).select(F.concat(F.lit("key-"), F.col("id")).alias("k"), F.col("id").alias("n"),
                                      F.lit(at(0)).alias("updated_at"))
    store.upsert(big, 0, at(0))
    store.upsert(batch(spark, [("key-7", -1, 1)]), 1, at(1))
    first, second = store.manifest()["deltas"]
    assert second["bytes"] * 100 < first["bytes"]
    store.upsert(batch(spark, [("key-8", -2, 2)]), 2, at(2))
    store.upsert(batch(spark, [("new", -3, 3)]), 3, at(3))      # four deltas: the first base
    m = store.manifest()
    assert m["deltas"] == [] and m["base"]["bytes"] > 100 * second["bytes"]
    for i in range(4, 9):                                       # small ones are merged among themselves
        store.upsert(batch(spark, [(f"key-{i}", -i, i)]), i, at(i))
    again = store.manifest()
    assert again["base"] == m["base"] and len(again["deltas"]) == 2 and again["deltas"][0]["name"].startswith("run-")
    got = {r.k: r.n for r in store.read().where("n < 0").collect()}
    assert got == {"key-7": -1, "key-8": -2, "new": -3, **{f"key-{i}": -i for i in range(4, 9)}} | {"key-7": -7, "key-8": -8}
    assert store.read().count() == 200_001


def _scanned(df):
    """(files, bytes) that the scans of an executed plan without exchange read."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()
    leaves, files, size = plan.collectLeaves(), 0, 0
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        files += metrics.apply("numFiles").value()
        size += metrics.apply("filesSize").value()
    return files, size


def test_lookup_opens_only_the_requested_part(spark, scratch):
    store = KeyedStore(spark, f"{scratch}/s", ("k",), ("n",), buckets=32, max_deltas=3)
    big = spark.range(50_000).select(F.concat(F.lit("key-"), F.col("id")).alias("k"), F.col("id").alias("n"),
                                     F.lit(at(0)).alias("updated_at"))
    store.upsert(big, 0, at(0))
    store.upsert(big.where("n < 5000").withColumn("n", -F.col("n")).withColumn("updated_at", F.lit(at(1))), 1, at(1))
    whole = _scanned(store._rows(store.manifest(), store.folders(store.manifest())))
    sizes = []
    for n in (1, 4, 16, 20_000):
        wanted = spark.range(n).select(F.concat(F.lit("key-"), F.col("id") * 2).alias("k"))
        files, size = _scanned(store.scan(wanted))
        sizes.append(size)
        assert files <= 2 * n
        got = {r.k: r.n for r in store.read_keys(wanted).join(wanted, "k", "left_semi").collect()}
        want = {f"key-{2 * i}": (-2 * i if 2 * i < 5000 else 2 * i) for i in range(n)}
        assert got == want
    assert sizes[0] * 20 < whole[1] and sizes == sorted(sizes) and sizes[-1] == whole[1]
    plan = store.scan(spark.createDataFrame([("key-2",)], "k string"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan and "PushedFilters: [In(k, [key-2])" in plan or "EqualTo(k,key-2)" in plan


@pytest.mark.parametrize("miss", [lk.DROP, lk.ZERO, lk.NULL])
def test_lookup_equals_whole_state(spark, scratch, miss):
    store = KeyedStore(spark, f"{scratch}/s", ("k",), ("n",), buckets=8, max_deltas=3)
    for i in range(5):
        store.upsert(batch(spark, [(f"k{(i * 7 + j) % 23}", 100 * i + j, i) for j in range(9)]), i, at(i))
    req = spark.createDataFrame([(i, f"k{i % 40}" if i % 9 else None) for i in range(200)], "id long, k string")
    plain = lk.lookup(req, store.read(), "k", value_col="n", on_miss=miss)
    pruned = lk.lookup(req, store.read_keys(req.select("k")), "k", value_col="n", on_miss=miss)
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(plain) == key(pruned) and plain.count() > 50


def test_reopen_crash_and_types(spark, scratch):
    """A second store object on the path; a delta that no manifest names; a
    batch of another time type; two writers; two key columns."""
    a = KeyedStore(spark, f"{scratch}/s", ("k",), ("n",), buckets=5)
    assert a.read().collect() == [] and a.read_keys(batch(spark, []).select("k")).collect() == []
    a.upsert(batch(spark, [("a", 1, 1)]), 0, at(0))
    b = KeyedStore(spark, f"{scratch}/s", ("k",), ("n",), buckets=9)
    assert b.manifest()["buckets"] == 5
    b._write(b._rows(b.manifest(), b.folders(b.manifest())), b.manifest(), "delta-2")     # written, never committed
    ntz = batch(spark, [("a", 2, 2), ("b", 3, 2)]).withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))
    b.upsert(ntz.withColumn("n", F.col("n").cast("int")), 1, at(1))
    b.upsert(batch(spark, [("c", 4, 3)]), 0, at(2), writer="other")
    b.upsert(batch(spark, [("c", 5, 4)]), 0, at(3))                  # a replay of the first writer
    assert rows_of(a.read()) == [("a", 2, at(2)), ("b", 3, at(2)), ("c", 4, at(3))]
    b.compact(whole=True)
    assert rows_of(a.read()) == [("a", 2, at(2)), ("b", 3, at(2)), ("c", 4, at(3))]
    two = KeyedStore(spark, f"{scratch}/two", ("k", "n"), ("v",), "o", schema="k string, n long, v string, o long")
    rows = spark.createDataFrame([("a", 1, "x", 1), ("a", 2, "y", 1), ("a", 1, "z", 2)], "k string, n long, v string, o long")
    two.upsert(rows, 0)
    assert sorted(map(tuple, two.read_keys(rows.select("k", "n")).collect())) == [("a", 1, "z", 2), ("a", 2, "y", 1)]
    assert textfile.read_text(spark, scratch, "nothing") is None
