"""op3: the search against scoring every item for every passage, and the planted
items of the driver's table."""

import math
import os
import random
from collections import Counter

import pytest

from tallyflow.llm import decontam as dc
from tallyflow.llm.queries import op3_decontam
from odd_rows import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.01"


def _items(rnd, n=40):
    vocab = [f"v{i}" for i in range(120)]
    return [(k, *dc.question_answer(" ".join(rnd.choices(vocab, k=rnd.randint(4, 20))).capitalize() + ". "
                                    + " ".join(rnd.choices(vocab, k=rnd.randint(1, 8))).capitalize() + "."))
            for k in range(n)], vocab


def _plain(docs, items, theta=dc.THETA, overlap=dc.OVERLAP):
    """Every item scored for every passage: {(doc, item): (score, q, a, first word)}."""
    items = [(i, dc.words_of(q), dc.words_of(a)) for i, q, a in dict.fromkeys(items)]
    items = [x for x in items if x[1] or x[2]]
    df = Counter(w for _, q, a in items for w in {*q, *a})
    gram = lambda w, n: {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
    out = {}
    for i, q, a in items:
        weight = {w: math.log1p((len(items) - df[w] + 0.5) / (df[w] + 0.5)) * c * 2.2 / (c + 1.2)
                  for w, c in Counter(q + a).items()}
        own = theta * sum(weight.values())
        most = 8
        while most < len(q) + len(a):
            most *= 2
        for d, text in docs:
            words = dc.words_of(text or "")
            for s in range(0, len(words), most // 2):
                part = words[s:s + 3 * (most // 2)]
                score = sum(weight.get(w, 0) for w in set(part)) / own
                if score < 1 - 1e-9:
                    continue
                share = lambda x: len(gram(x, min(3, len(x))) & gram(part, min(3, len(x)))) / len(
                    gram(x, min(3, len(x)))) if x else 1.0
                hit = (score, share(q), share(a), s)
                if hit[1] >= overlap and hit[2] >= overlap:
                    old = out.get((d, i))
                    if old is None or (hit[1] + hit[2], round(score, 9)) > (old[1] + old[2], round(old[0], 9)):
                        out[d, i] = hit
    return out


def _spark(spark, docs, items, **kw):
    got = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                   spark.createDataFrame(items, "item_id long, question string, answer string"), **kw).collect()
    assert len({(r.doc_id, r.item_id) for r in got}) == len(got)
    return {(r.doc_id, r.item_id): (r.score, r.question_overlap, r.answer_overlap, r.first_word) for r in got}


def _same(got, want):
    assert set(got) == set(want)
    for k in want:
        assert got[k][:3] == pytest.approx(want[k][:3]) and got[k][3] == want[k][3]


def _corpus(seed, n_items=60, n_docs=150):
    """Documents with whole, altered and partial copies of items."""
    rnd = random.Random(seed)
    items, vocab = _items(rnd, n_items)
    docs = []
    for d in range(n_docs):
        words = rnd.choices(vocab + ["zz"] * 40, k=rnd.randint(0, 150))
        if d % 2:
            _, q, a = rnd.choice(items)
            copy = [w for w in f"{q} {a}".split() if rnd.random() > 0.03 * (d % 9)]
            words += copy + rnd.choices(vocab, k=rnd.randint(0, 30))
        docs.append((d, " ".join(words)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("theta, overlap", [(0.7, 0.6), (0.5, 0.3)])
def test_search_is_that_of_every_item_for_every_passage(spark, seed, theta, overlap):
    docs, items = _corpus(seed)
    want = _plain(docs, items, theta, overlap)
    assert len(want) >= 15 and any(s[1] < 1 for s in want.values())
    _same(_spark(spark, docs, items, theta=theta, overlap=overlap), want)


@pytest.mark.parametrize("limit", [1, 100, 400])
def test_pieces_change_nothing(spark, monkeypatch, limit):
    docs, items = _corpus(4)
    want = _plain(docs, items, 0.5, 0.3)
    monkeypatch.setattr(dc, "PIECE_POSTINGS", limit)
    monkeypatch.setattr(dc, "CELLS", 64)
    _same(_spark(spark, docs, items, theta=0.5, overlap=0.3), want)


def test_a_long_item_changes_no_other(spark):
    """The passages of short items are as before; an item of 5,000 words is found itself."""
    docs, items = _corpus(5)
    far = " zz " * 2000
    q, a = "alpha beta gamma delta", "epsilon zeta"
    items += [(900, q, a)]
    docs += [(900, f"{q} {far} {a}"), (901, f"{far} {q} {a} {far}")]
    long_item = (901, " ".join(f"u{k}" for k in range(4990)), "ten more words of its own close the long item")
    before = _spark(spark, docs, items)
    after = _spark(spark, [*docs, (902, f"{far} {long_item[1]} {long_item[2]}")], [*items, long_item])
    assert (900, 900) not in before and (901, 900) in before
    assert {k for k in after if k[1] != 901} == set(before) and {k for k in after if k[1] == 901} == {(902, 901)}
    assert all(after[k][1:] == before[k][1:] for k in before)


def test_recall_of_partly_copied_items(spark):
    """The search finds all copies that scoring every passage finds: of those that
    lack one word in twenty, most; the others miss the overlap of short answers."""
    rnd = random.Random(11)
    words = [f"n{k}" for k in range(5000)]
    items = [(k, " ".join(rnd.choices(words, k=rnd.randint(20, 40))), " ".join(rnd.choices(words, k=rnd.randint(8, 20))))
             for k in range(100)]
    docs = [(k, " ".join(rnd.choices(words, k=100) + [w for w in f"{q} {a}".split() if rnd.random() > 0.05]
                         + rnd.choices(words, k=100))) for k, q, a in items]
    got = _spark(spark, docs, items)
    _same(got, _plain(docs, items))
    assert set(got) <= {(k, k) for k in range(100)} and len(got) >= 85


def test_ties_and_repeated_items(spark):
    q, a = "which of the seven rivers runs north", "the slow green river"
    pad = " ".join(f"pad{k}" for k in range(64))
    docs = [(1, f"{pad} {q} {a} {pad} {q} {a} {pad}")]
    items = [(1, q, a), (1, q, a), (1, "some other words that stand alone", "in a quite different item"), (None, q, a)]
    got = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                   spark.createDataFrame(items, "item_id long, question string, answer string")).collect()
    want = _plain(docs, [(1, q, a), (2, *items[2][1:]), (3, q, a)])
    assert sorted((str(r.item_id), r.first_word) for r in got) == [("1", want[1, 1][3]), ("None", want[1, 3][3])]
    assert want[1, 1][3] < 70


def test_overlap_needs_question_and_answer(spark):
    q, a = "which of the seven rivers runs north through the old town", "the slow green river"
    items = [(1, q, a), (2, "a quite different question about birds", "sparrows mostly eat seed")]
    pad = " ".join(f"pad{i}" for i in range(200))
    texts = [f"{pad} {q} {a} {pad}", f"{pad} {q.title()}? {a.upper()}! {pad}", f"{pad} {q} {pad}", f"{a} {pad}", pad, "", None]
    assert set(_spark(spark, list(enumerate(texts)), items)) == {(0, 1), (1, 1)}


def test_question_answer():
    assert dc.question_answer("One two. Three four!\nFive six.") == ("One two. Three four!", "Five six.")
    assert dc.question_answer("a b c d e f") == ("a b c d", "e f")
    assert dc.question_answer("") == ("", "")


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "A b c d e f g. H i j k l m n."), (2, None), (None, ""), (3, "...")],
                                  "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in dc.leaks(odd_docs, bench).collect()), key=repr)
    assert got == sorted([(1, 1), (1, 1), (2, 1), (None, 1)], key=repr)
    kept = dc.clean(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 4
    assert dc.leaks(no_docs, bench).count() == 0 and dc.clean(no_docs, bench).count() == 0
    none = bench.where("false")
    assert dc.leaks(odd_docs, none).count() == 0 and dc.clean(odd_docs, none).count() == odd_docs.count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_query_finds_every_verbatim_item(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    assert {(r.doc_id, r.item_id) for r in op3_decontam(spark, SF).collect()} == want and want


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_query_against_every_passage(spark):
    sf = SF.replace("0.01", "0.001")
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, *dc.question_answer(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): (r.score, r.question_overlap, r.answer_overlap, r.first_word)
           for r in op3_decontam(spark, sf).collect()}
    _same(got, _plain(docs, items))
