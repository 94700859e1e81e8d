"""K6: the sorted set after several updates against ranking from scratch, and
what an update and a query touch."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tallyflow.session import with_conf
from tallyflow.sinks import sorted_set
from tallyflow.sinks.sorted_set import SortedSet


def model(scores):
    return sorted(((k, s, 1 + sum((t is not None) if s is None else (t is not None and t > s) for t in scores.values()))
                   for k, s in scores.items()), key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_updates_against_scratch(spark, scratch, seed):
    """Members that rise, fall, tie and lose their score; replays; ranges that
    split; every page and rank as from scratch."""
    rnd = random.Random(seed)
    s = SortedSet(spark, f"{scratch}/set", range_rows=3, buckets=4, max_deltas=2)
    assert s.page(1, 10).collect() == []
    scores = {}
    for i in range(5):
        batch = [(rnd.choice([f"m{rnd.randrange(30)}", None]), rnd.choice([None, rnd.randrange(6), rnd.randrange(1000)])) for _ in range(18)]
        df = spark.createDataFrame(batch, "key string, score long")
        s.update(df, i)
        s.update(df, i)
        new = {}
        for k, v in batch:
            new[k] = max((x for x in (new.get(k), v) if x is not None), default=None)
        scores |= new
        assert sum(r["count"] for r in s.ranges()["ranges"]) == len(scores)
    want = model(scores)
    assert len(s.ranges()["ranges"]) > 4
    assert rows(s.page(1, 1000)) == want
    for a, b in ((1, 3), (4, 9), (len(want) - 2, len(want))):
        assert rows(s.page(a, b)) == [r for r in want if a <= r[2] <= b]
    asked = ["m1", "m7", None, "nobody"]
    got = rows(s.ranks(spark.createDataFrame([(k,) for k in asked], "key string")))
    assert got == [r for r in want if r[0] in asked]


def test_an_update_touches_its_ranges(spark, scratch):
    s = SortedSet(spark, f"{scratch}/set", range_rows=100)
    s.update(spark.range(2000).selectExpr("concat('k', id) AS key", "id AS score"), 0)
    before = s.ranges()["ranges"]
    assert len(before) >= 15 and max(r["count"] for r in before) < 250
    s.update(spark.createDataFrame([("k1000", 1999), ("new", 1999)], "key string, score long"), 1)
    after = s.ranges()["ranges"]
    assert sum(a != b for a, b in zip(before, after)) == 2 and len(before) == len(after)
    assert rows(s.page(1, 1)) == [("k1000", 1999, 1), ("k1999", 1999, 1), ("new", 1999, 1)]
    assert len(s.chosen(1, 20)) == 1 and rows(s.page(2, 3)) == []
    plan = s.page(1, 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2          # one range, read for its scores and for its members
    s.update(spark.range(500).selectExpr("concat('t', id) AS key", "7L AS score"), 2)       # one score is never split
    assert max(r["count"] for r in s.ranges()["ranges"]) >= 500
    assert {r.rank for r in s.page(1, 3000).where("score = 7").collect()} == {1994}


def test_a_batch_is_evaluated_once(spark, scratch):
    """A batch that makes the set, one that changes and one that splits it."""
    made = spark.sparkContext.accumulator(0)

    def seen(row):
        made.add(1)
        return row

    s = SortedSet(spark, f"{scratch}/set", range_rows=20)
    for i, n in enumerate((50, 5, 300)):
        df = spark.range(n).selectExpr("concat('k', id) AS key", f"id * {i + 1} AS score")
        before = made.value
        s.update(spark.createDataFrame(df.rdd.map(seen), "key string, score long"), i)
        assert made.value - before == n
    assert rows(s.page(1, 2)) == [("k298", 894, 2), ("k299", 897, 1)]
    assert os.listdir(f"{scratch}/set").count("batch-2") == 0


def test_ranks_of_many_ranges_are_one_plan(spark, scratch):
    s = SortedSet(spark, f"{scratch}/set", range_rows=20)
    s.update(spark.range(1000).selectExpr("concat('k', id) AS key", "if(id < 300, 1, id) AS score"), 0)
    assert len(s.ranges()["ranges"]) > 30
    asked = spark.range(0, 1010, 7).selectExpr("concat('k', id) AS key")
    ranked = s.ranks(asked)
    got = rows(ranked.where("key < 'k3'"))
    assert got == rows(spark.range(0, 1000, 7).selectExpr("concat('k', id) AS key", "if(id < 300, 1, id) AS score",
                                                          "if(id < 300, 701, 1000 - id) AS rank").where("key < 'k3'"))
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("FileScan") <= 4 and "Union" not in plan


def test_a_range_of_one_score_is_several_files(spark, scratch, monkeypatch):
    monkeypatch.setattr(sorted_set, "FILE_ROWS", 50)
    s = SortedSet(spark, f"{scratch}/set", range_rows=20)
    with with_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        s.update(spark.range(1000).selectExpr("concat('k', id) AS key", "7L AS score"), 0)
    large, = [r for r in s.ranges()["ranges"] if r["count"]]
    per_file = spark.read.parquet(f"{scratch}/set/{large['folder']}").groupBy(F.input_file_name()).count().collect()
    assert large["count"] == 1000 and len(per_file) >= 3
    assert s.page(1, 1).count() == 1000


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7, 8, 9, 31])
def test_place_among_bounds(spark, scratch, n):
    lows = [3 * k for k in range(n)]
    s = SortedSet(spark, f"{scratch}/set")
    scores = spark.createDataFrame([(x,) for x in (None, *range(-2, 3 * n + 3))], "score long")
    got = {r.score: r.p for r in scores.select("score", s._place(["null", "lowest", *lows]).alias("p")).collect()}
    assert got == {x: 0 if x is None else 1 + sum(b <= x for b in lows) for x in got}


def test_reopened_after_a_failure(spark, scratch):
    """The ranges were replaced, the store of scores was not: the replay
    brings the store up, and a later update finds the old score."""
    s = SortedSet(spark, f"{scratch}/set", range_rows=3)
    df = spark.createDataFrame([("a", 1), ("b", 2)], "key string, score long")
    s._rewrite(s.ranges(), df, 0)
    s = SortedSet(spark, f"{scratch}/set", range_rows=3)
    s.update(df, 0)
    s.update(spark.createDataFrame([("a", 5)], "key string, score long"), 1)
    assert rows(s.page(1, 9)) == [("a", 5, 1), ("b", 2, 2)]
