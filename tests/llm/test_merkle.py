"""op12: against a plain tree built in one process. The query's SQL is compared
in test_tables."""

import hashlib
import random
import zlib

import pytest

from tallyflow.llm import merkle as mk
from odd_rows import no_docs, odd_docs  # noqa: F401


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    vals = (r.doc_id, r.source, r.lang, r.n_chars, text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k:k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def siblings(lv, k):
    out = []
    for level in lv[:-1]:
        lo = k - k % 8
        out.append((level[lo:k], level[k + 1:lo + 8]))
        k //= 8
    return out


def plain(rows):
    """The result of op12 by hand: the whole tree, each proof folded alone."""
    langs = sorted({r.lang for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r) for r in rows if r.lang == lang), key=lambda t: t[:3])
        trees[lang] = ([t[3] for t in own], levels([t[2] for t in own]))
    top = levels([trees[x][1][-1][0] for x in langs])
    out = []
    for i, lang in enumerate(langs):
        own, lv = trees[lang]
        for k, r in enumerate(own):
            sib = siblings(lv, k) + siblings(top, i)
            text = r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(r, text)
            for left, right in sib:
                node = h(*left, node, *right)
            out.append((r.doc_id, lv[0][k], lv[-1][0], top[-1][0], h(*[x for a, b in sib for x in a + b]), node, node == top[-1][0]))
    return sorted(out, key=repr)


def run(docs):
    return sorted(map(tuple, mk.verify(docs, mk.tampered(docs)).collect()), key=repr)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("sizes", [[1], [9, 8, 2, 1], [513, 64, 65, 1, 1, 1, 7, 1, 30, 5]])
def test_against_plain_tree(spark, monkeypatch, sizes):
    """Sizes around whole runs and, with blocks of 8 leaves, several rounds of blocks."""
    rnd = random.Random(len(sizes))
    rows, ids = [], rnd.sample(range(-5000, 5000), sum(sizes))
    for j, n in enumerate(sizes):
        for _ in range(n):
            rows.append((ids.pop(), rnd.choice(["Some Text", "lower only", "", None, "ÄÖ ß"]), None if j == 3 else f"l{j % 3}{j}",
                         rnd.choice(["s", None]), rnd.choice([1, None])))
    docs = spark.createDataFrame(rows, SCHEMA)
    want = plain(docs.collect())
    assert run(docs) == want
    monkeypatch.setattr(mk, "LEVELS", 1)
    monkeypatch.setattr(mk, "SPAN", 8)
    assert run(docs) == want
    monkeypatch.setattr(mk, "RUNS", 0)
    assert run(docs) == want


def test_versions_share_all_but_the_way(spark):
    """A version's copies are its leaf and that leaf's ancestors, and folding
    the siblings with them gives each next one."""
    rows = [(i, f"T{i}", "en" if i % 3 else "fr", "s", i) for i in range(700)]
    docs = spark.createDataFrame(rows, SCHEMA)
    base = levels([leaf(r, r.text) for r in sorted(docs.collect(), key=lambda r: r.doc_id) if r.lang == "en"])
    out = mk.versions(mk.leaves(docs, mk.tampered(docs))).where("tree = '=en'").collect()
    assert len(out) == 466
    for r in out:
        sib = siblings(base, r.idx)
        assert len(r.copies) == len(base) + 1       # leaf, ancestors to the subroot, root
        node = r.copies[0]
        for (left, right), copy in zip(sib, r.copies[1:]):
            node = h(*left, node, *right)
            assert node == copy
        changed = zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        assert (r.copies[0] != r.leaf) == changed and (r.copies[-1] != r.root) == changed


def test_odd_rows(odd_docs, no_docs):
    assert run(odd_docs) == plain(odd_docs.collect())
    assert mk.verify(no_docs, mk.tampered(no_docs)).collect() == []


def test_missing_columns_count_as_null(spark):
    few = spark.createDataFrame([(1, "A"), (2, "b")], "doc_id long, text string")
    full = few.selectExpr("doc_id", "text", "cast(null as string) lang", "cast(null as string) source", "cast(null as long) n_chars")
    assert run(few) == plain(full.collect())
