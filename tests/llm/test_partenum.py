"""op2: signatures, components and the whole join against brute force."""

import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyflow.llm import partenum as pe
from tallyflow.llm.components import components
from tallyflow.llm.queries import op2_partenum
from odd_rows import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.001"


def brute(rows, words, percent):
    """doc_id -> (set size, smallest linked doc_id), rows (doc_id, text) in order."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        k = min(words, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    return sorted(((rows[k][0], len(sets[k]), min((i for i in groups[find(k)] if i is not None), default=None))
                   for k in range(len(rows))), key=repr)


def joined(df, words, percent):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in pe.join(df, words, percent).collect()), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=80), st.integers(1, 40))
def test_word_hashes(data, cut):
    words = data.lower().split()
    before, pe.SLICE = pe.SLICE, cut
    try:
        sliced = pe.word_hashes(data)
    finally:
        pe.SLICE = before
    whole = pe.word_hashes(data)
    assert (sliced == whole).all() and len(whole) == len(words)
    assert len(set(zip(words, whole.tolist()))) == len(set(words)) == len(set(whole.tolist()))


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_linked_sets_share_the_signatures_they_need(percent):
    """Sets at the very edge of the similarity, of all sizes, with and without
    a difference in size; sketches never differ in more bits than the sets."""
    rnd, scheme = random.Random(percent), pe.Scheme(percent)
    for n in [*range(1, 40), *range(40, 400, 23), 1500, 6000]:
        for _ in range(30 if n < 100 else 6):
            a = np.array([rnd.getrandbits(64) for _ in range(n)], dtype=np.uint64)
            drop = rnd.randint(0, n * (100 - percent) // 100)
            add = 0
            while 100 * (n - drop) >= percent * (n + add + 1) and rnd.random() < 0.9:
                add += 1
            b = np.concatenate([a[drop:], np.array([rnd.getrandbits(64) for _ in range(add)], dtype=np.uint64)])
            if not len(b) or 100 * (n - drop) < percent * (n + add):
                continue
            x, y = np.unique(a), np.unique(b)
            if drop + add:
                both = set(scheme.sign(x).tolist()) & set(scheme.sign(y).tolist())
                assert len(both) >= max(scheme.need(x), scheme.need(y)), (n, drop, add)
            bits = np.bitwise_xor(pe.sketch(a), pe.sketch(b)).tobytes()
            assert sum(x.bit_count() for x in bits) <= drop + add


def corpus(seed):
    """Near copies of a few texts, straddling the threshold, a shared passage,
    exact copies in other case, short and empty texts."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefgh") + str(rnd.randint(0, 400))
    passage = " ".join(word() for _ in range(60))
    bases = [" ".join(word() for _ in range(rnd.choice([6, 9, 30, 120, 300]))) for _ in range(7)]
    rows = []
    for _ in range(150):
        w = rnd.choice(bases).split()
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5, 8])):
            k = rnd.randrange(len(w))
            w[k:k + 1] = rnd.choice([[word()], [], [w[k], word()]])
            w = w or [word()]
        rows.append(" ".join(w).upper() if rnd.random() < 0.2 else " ".join(w))
    rows += [f"{passage} {' '.join(word() for _ in range(rnd.randint(2, 12)))}" for _ in range(40)]
    rows += ["", None, "  ", "one", "one", "two words", "two  WORDS"]
    rnd.shuffle(rows)
    return list(zip(rnd.sample(range(1000), len(rows)), rows))


@pytest.mark.parametrize("words,percent,seed", [(4, 85, 1), (5, 80, 2), (1, 90, 3)])
def test_join_against_brute_force(spark, monkeypatch, words, percent, seed):
    monkeypatch.setattr(pe, "LARGE", 5)           # large and huge buckets on a small table
    monkeypatch.setattr(pe, "HUGE", 10)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert joined(df, words, percent) == brute(rows, words, percent)


def test_hot_signatures_change_nothing(spark, monkeypatch):
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    scheme = pe.Scheme(85)
    every = np.unique(np.concatenate([scheme.sign(pe.shingles(t, 4)) for _, t in rows if t and t.strip()]).view(np.int64))
    monkeypatch.setattr(pe, "hot_signatures", lambda *a: every)
    assert joined(df, 4, 85) == brute(rows, 4, 85)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert joined(odd_docs, 4, 85) == brute(rows, 4, 85)


def test_no_rows(no_docs):
    assert pe.join(no_docs).count() == 0 and pe.keep_one(no_docs).count() == 0


def test_keep_one(spark, odd_docs):
    kept = pe.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    # ids 1, 2 and the null row are one group; rows that repeat id and text count once
    assert sorted(((r.doc_id, (r.text or "")[:5]) for r in kept.collect()), key=repr) == sorted(
        [(1, "a b c"), (3, ""), (4, ""), (5, " \n\t "), (6, "one"), (6, "two w"), (None, ""), (None, "nobod"),
         (7, "w0x0 "), (8, "x\ny\nz"), (9, "é ü　ß"), (-5, "minus")], key=repr)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    root = {x: x for e in links for x in e}
    for _ in links:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    want = {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in links)}
    assert got == want


def test_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r.root for r in components(df).collect()} == {0}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in op2_partenum(spark, SF).collect()), key=repr)
    assert got == brute(rows, 4, 85)
