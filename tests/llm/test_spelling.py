"""op13: against comparing every two words, and the query's words by hand. Its
SQL is compared in test_tables."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyflow.llm import spelling as sp
from odd_rows import no_docs, odd_docs  # noqa: F401


def one_edit(x, y):
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(p != q for p, q in zip(x, y)) == 1
    return any(y[:k] + y[k + 1:] == x for k in range(len(y)))


def plain_words(rows):
    n = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def plain(words, ratio=10):
    forms, out = {}, []
    for w, n in words.items():
        near = sorted((-words[v], v) for v in words if one_edit(w, v))
        best = near[0] if near and -near[0][0] >= ratio * n else None
        forms[w] = (len(near), best[1] if best else None, -best[0] if best else None)
    for w, n in words.items():
        root = w
        while forms[root][1] is not None:
            root = forms[root][1]
        out.append((w, forms[w][1], root, n, forms[w][0], forms[w][2]))
    return sorted(out)


def run(spark, words, **more):
    df = spark.createDataFrame(list(words.items()) or [("x", 1)], "word string, n long")
    return sorted(map(tuple, sp.group(df if words else df.where("false"), **more).collect()))


word = st.text(alphabet="abé一\U0001f600", min_size=1, max_size=6)


@settings(max_examples=300, deadline=None)
@given(st.lists(word, min_size=2, max_size=30, unique=True), st.sampled_from([16, 200, 1 << 18]))
def test_tiles_against_all_pairs(words, cells):
    """One group per length of the longer word holds all pairs; any block height."""
    got = set()
    for b in {len(w) + d for w in words for d in (0, 1)}:
        own = [w for w in words if len(w) in (b - 1, b)]
        k = len(own)
        same = lambda x: np.full(k, x)
        for i, j in sp.near(own, same(0), same(b), same(0), same(b - 1), cells=cells):
            for x, y in zip(i.tolist(), j.tolist()):
                assert (own[x], own[y]) not in got and (own[y], own[x]) not in got
                got.add((own[x], own[y]))
    assert {frozenset(p) for p in got} == {frozenset((x, y)) for x in words for y in words if one_edit(x, y)}


@pytest.mark.parametrize("tile", [512, 2])
def test_groups_and_forms(spark, monkeypatch, tile):
    """Hot prefixes and suffixes, chains of forms and ties; also when every
    group is split as far as it goes."""
    monkeypatch.setattr(sp, "TILE", tile)
    rnd = random.Random(3)
    words = {}
    for stem in ("internation", "tion", "abcdefg"):
        for _ in range(60):
            w = stem + "".join(rnd.choices("abc", k=rnd.randint(0, 4)))
            words[w] = 10 ** rnd.randint(0, 4)
            v = "".join(rnd.choices("abc", k=rnd.randint(0, 4))) + stem
            words[v] = rnd.choice([1, 5, 50])
    words |= {"chainaaa": 1, "chainaab": 10, "chainabb": 100, "chainbbb": 1000, "chbinbbb": 10000, "y" * 5000: 3, "y" * 5001: 40,
              "一丁": 2, "一": 30, "z": 1}
    want = plain(words)
    assert run(spark, words) == want
    assert {w: r for w, _, r, *_ in want}["chainaaa"] == "chbinbbb"
    assert any(n_near > 2 for *_, n_near, _ in want)


def test_each_pair_is_in_one_group(spark, monkeypatch):
    monkeypatch.setattr(sp, "TILE", 2)
    words = [a + b + c for a in "xy" for b in ("", "mmm", "mnm", "nnnn") for c in ("aaaa", "aaa", "aab")]
    rows = sp.groups(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()
    for x in words:
        for y in words:
            if x < y and one_edit(x, y):
                b = max(len(x), len(y))
                a = min(next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y))), b - 1)
                at = lambda w: {(r.b, r.lo, r.hi, r.g) for r in rows if r.word == w and r.b == b and r.lo <= a <= r.hi}
                assert len(at(x) & at(y)) == 1, (x, y)


def test_empty_and_null_words(spark):
    assert run(spark, {}) == []
    df = spark.createDataFrame([(None, 5), ("abc", 2), ("", 1)], "word string, n long")
    assert sorted(map(tuple, sp.group(df).collect())) == [("", None, "", 1, 0, None), ("abc", None, "abc", 2, 0, None)]


def test_words_of_texts(spark, odd_docs, no_docs):
    rnd = random.Random(9)
    stems = ["Straße", "élèvement", "Recherche", "international", "Übergang", "wörterbuch", "petit"]
    rows = [(rnd.choice([None, *range(400)]), " ".join(rnd.choices(stems, k=40)) + "; x1nternational-überĀgangen") for _ in range(60)]
    rows += [(1, None), (2, ""), (3, "A" * 30_000), (3, "A" * 30_000)] + rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for df in (docs, odd_docs):
        assert {r.word: r.n for r in sp.vocabulary(df).collect()} == plain_words(df.collect())
    assert sp.group(sp.vocabulary(no_docs)).collect() == []
    words = plain_words(docs.collect())
    got = sorted(map(tuple, sp.group(sp.vocabulary(docs)).collect()))
    assert got == plain(words) and any(form for _, form, *_ in got)
