"""op9: the learner, the fold, held-out accuracy and the odd cases."""

import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tallyflow.llm import quality as q
from tallyflow.llm.queries import op9_quality
from odd_rows import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.1"


def test_learner_separates():
    of, model = q.Features(), q.FTRL()
    good, bad = "the river runs slowly north", "BUY!! NOW!! CHEAP!! PILLS!!"
    for _ in range(20):
        model.update(*of(good), 1.0)
        model.update(*of(bad), 0.0)
    w = model.weights()
    p = lambda t: q._sigmoid(float(w[of(t)[0]] @ of(t)[1]))
    assert p(good) > 0.8 and p(bad) < 0.2 and p("MORE!! OF!! IT!!") < p("a quiet day")


def test_features():
    of = q.Features()
    i, v = of("aa bb aa")
    assert i[0] == 0 and v[0] == 1 and i.max() <= 1 << q.BITS
    assert [x.tolist() for x in of(None)] == [x.tolist() for x in of("")] == [[0], [1.0]]
    assert q.shape("Hello!!") == "Aa!" and q.shape("ab12") == "a0"


def test_fold_and_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (6, None), (None, 1), (99, 1)], "doc_id long, quality int")
    w = q.train(odd_docs, labels)
    rows = odd_docs.select("doc_id", "text", q.held_out(odd_docs.doc_id).alias("out"),
                           q.probability(odd_docs, w).alias("p")).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.p <= 1
    assert len({r.p for r in rows if not (r.text or "").strip()}) == 1
    kept = q.keep(odd_docs, w, least=0.0)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert q.keep(no_docs, w).count() == 0
    none = q.train(odd_docs, labels.where("false"))
    assert not none.any()
    assert {r.p for r in odd_docs.select(q.probability(odd_docs, none).alias("p")).collect()} == {0.5}


def test_labels_of_the_held_out_fold_are_not_read(spark):
    rows = [(i, f"good words number {i}" if i % 2 else f"BAD!! {i} BAD!!", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    flipped = df.withColumn("quality", q.F.when(q.held_out(df.doc_id), 1 - df.quality).otherwise(df.quality))
    assert (q.train(df, df) == q.train(df, flipped)).all()


def test_repeated_rows_change_nothing(spark):
    rows = [(i, f"good words number {i}" if i % 2 else f"BAD!! {i} BAD!!", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    other = spark.createDataFrame([(i, f"later {i}") for i in range(60)], "doc_id long, text string")
    once = q.train(df, df)
    assert once.any() and (once == q.train(df.unionByName(df).unionByName(df), df)).all()
    assert (once[:] == q.train(df.select("doc_id", "text").unionByName(other.withColumn("text", q.F.concat(
        q.F.lit("zzz "), "text"))), df)).all()


def test_bounds_of_the_sample(spark):
    rows = [(i, "good words " + "x " * i if i % 2 else f"BAD!! {i} BAD!!", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    assert (q.train(df, df, max_features=10 ** 6) == q.train(df, df)).all()
    assert not q.train(df, df, max_features=0).any() and not q.train(df, df, max_train=0).any()


def _plain_features(text):
    """{index: value} by plain integers."""
    def mix(x, seed):
        x = (x ^ (0x9E3779B97F4A7C15 * seed)) * 0xBF58476D1CE4E5B9 % 2 ** 64
        x = (x ^ x >> 29) * 0x94D049BB133111EB % 2 ** 64
        return x ^ x >> 32

    words = (text or "").split()
    h = [xxhash.xxh3_64_intdigest(w.encode()) for w in words]
    shapes = [xxhash.xxh3_64_intdigest(q.shape(w).encode()) for w in words]
    shapes = [mix((2 * s + (k > 0 and h[k] == h[k - 1])) % 2 ** 64, 3) for k, s in enumerate(shapes)]
    out = [(0, 1.0)]
    for xs, seed in ((h, 5), (shapes, 7)):
        grams = [mix(x % 2 ** 64, seed) for x in xs] + [mix((31 * a + b) % 2 ** 64, seed + 10) for a, b in zip(xs, xs[1:])]
        n = Counter((g & (1 << q.BITS) - 2) + 1 for g in grams)
        length = math.sqrt(sum(math.log1p(c) ** 2 for c in n.values()))
        out += [(i, math.log1p(c) / length) for i, c in sorted(n.items())]
    return out


def _plain_scores(docs, labels, alpha=0.3, beta=1.0, l1=0.02, l2=0.5):
    z, n = Counter(), Counter()

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else (math.copysign(l1, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    rows = [(_plain_features(docs[i]), labels[i]) for i in labels if i in docs]
    score = lambda f: 1 / (1 + math.exp(-sum(weight(i) * v for i, v in f)))
    for _ in range(2):
        for f, y in rows:
            p, old = score(f), [weight(i) for i, _ in f]
            for (i, v), w in zip(f, old):
                g = (p - y) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w
                n[i] += g * g
    return {i: score(_plain_features(t)) for i, t in docs.items()}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_query_against_a_plain_learner(spark):
    sf = SF.replace("0.1", "0.001")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = (spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null and crc32(cast(doc_id as string)) % 5 <> 0")
              .orderBy(q.F.xxhash64(q.F.col("doc_id").cast("long")), "doc_id").collect())
    want = _plain_scores(docs, {r.doc_id: r.quality for r in labels})
    got = {r.doc_id: r.score for r in op9_quality(spark, sf).collect()}
    assert got == pytest.approx(want, abs=2e-3) and len({round(p, 3) for p in want.values()}) > 5


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in op9_quality(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    out = [(got[r.doc_id], r.quality) for r in labels if got[r.doc_id].held_out]
    assert len(out) > 500
    assert np.mean([g.predicted == y for g, y in out]) > 0.98
    good = [g.score for g, y in out if y]
    bad = [g.score for g, y in out if not y]
    assert np.mean([a > b for a in good for b in bad]) > 0.99
