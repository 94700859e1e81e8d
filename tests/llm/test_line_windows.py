"""op8: against a plain pass over all windows. The query's SQL is compared in
test_tables."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyflow.llm import line_windows as lw
from odd_rows import no_docs, odd_docs  # noqa: F401


def brute(rows, lines=3):
    first, out = {}, []
    order = sorted({(i if i is not None else -1 << 63, t) for i, t in rows if t is not None}, key=lambda r: r[0])
    gone = {}
    for i, t in order:
        p = t.split("\n")
        cut = set()
        for k in range(len(p) - lines + 1):
            if first.setdefault(tuple(p[k:k + lines]), (i, t, k)) != (i, t, k):
                cut |= set(range(k, k + lines))
        gone[i, t] = cut
    for i, t in rows:
        cut = gone.get((i if i is not None else -1 << 63, t), set())
        p = t.split("\n") if t is not None else []
        out.append((i, "\n".join(x for k, x in enumerate(p) if k not in cut) if t is not None else None, len(p), len(cut)))
    return sorted(out, key=repr)


def _run(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in lw.dedup(df).collect()), key=repr)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "", "c"]), max_size=9).map("\n".join), max_size=6))
def test_against_brute_force(spark, texts):
    rows = list(enumerate(texts))
    assert _run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_passages_and_copies(spark):
    rnd = random.Random(1)
    lines = [f"line {i}" for i in range(30)]
    passage = [f"shared {i}" for i in range(6)]
    texts = ["\n".join(rnd.sample(lines, 5) + passage + rnd.sample(lines, 5)) for _ in range(40)]
    texts += texts[:10]
    rows = list(zip(rnd.sample(range(900), len(texts)), texts))
    got = _run(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows)
    assert sum("shared 3" in (t or "") for _, t, _, _ in got) == 1


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert _run(odd_docs) == brute(rows)
    assert lw.dedup(odd_docs).columns == [*odd_docs.columns, "n_lines", "n_removed"]
    assert lw.dedup(no_docs).count() == 0


def test_texts_without_repeats_are_not_shuffled(spark):
    """Only the texts that the bit filter finds reach the join with the runs;
    the filter loses none that has runs, and full it lets all through."""
    texts = [f"own {i}\nown too {i}\nown as well {i}" for i in range(300)] + ["p\nq\nr"] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lw.wrapped(docs, **lw._keys())
    some, none = lw.touched(rows, lw.stage(lw.covered(docs), "runs"))
    assert {r.id for r in some.collect()} == {301, 302, 303, 304} and none.count() == 301
    plan = none.select("_row")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert _run(docs) == brute(list(enumerate(texts)))


def test_full_filter(spark, monkeypatch):
    monkeypatch.setattr(lw, "BITS", 64)
    texts = [f"a {i % 40}\nb {i % 40}\nc {i % 40}\nd {i}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert _run(docs) == brute(list(enumerate(texts)))
