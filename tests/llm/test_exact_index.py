"""op6: the index over batches, and the odd cases. The query's SQL is compared
in test_tables."""

import hashlib

from tallyflow.llm.exact_index import DigestIndex, dedup, digests
from odd_rows import no_docs, odd_docs  # noqa: F401


def test_index_keeps_what_came_first(spark):
    index = DigestIndex(spark, buckets=4)
    batch = lambda *rows: digests(spark.createDataFrame(rows, "doc_id long, text string"))
    index.add(batch((1, "A"), (2, "a"), (3, "b")))
    index.add(batch((9, "a"), (8, "c"), (7, "C")))
    index.add(batch())
    got = {bytes(r.digest).hex(): r.keep_id for r in index.read().collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {sha("a"): 2, sha("b"): 3, sha("c"): 8}
    # the index side of the anti-join is read by bucket, without a shuffle
    plan = batch((5, "z")).join(index.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    index.close()



def test_two_sessions_on_one_path(spark, scratch):
    """A second session opens the path, finds the digests and the buckets, and
    adds; compaction leaves one file a bucket; nothing lies in the warehouse."""
    rows = lambda s, *r: digests(s.createDataFrame(r, "doc_id long, text string"))
    first = DigestIndex(spark, f"{scratch}/index", buckets=3)
    first.add(rows(spark, (1, "a"), (2, "b"), (2, "B")))
    other = spark.newSession()
    second = DigestIndex(other, f"{scratch}/index", buckets=9, most_files=3)
    assert second.buckets == 3 and second.read().count() == 2
    plan = rows(other, (5, "z")).join(second.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    second.add(rows(other, (9, "A"), (8, "c")))
    second.add(rows(other, (7, "d"), (6, "C")))             # the third file: compacted
    assert second.layout["files"] == 1 and second.layout["folder"] == "files-1"
    third = DigestIndex(spark.newSession(), f"{scratch}/index")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert {bytes(r.digest).hex(): r.keep_id for r in third.read().collect()} == {sha("a"): 1, sha("b"): 2, sha("c"): 8, sha("d"): 7}
    assert len(third.read().inputFiles()) <= 3 and all(f"{scratch}/index/" in f for f in third.read().inputFiles())
    third.compact()
    assert third.read().count() == 4 and third.layout["before"] == "files-1"


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    norm = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    want = []
    for i, t in rows:
        group = [j for j, u in rows if norm(u) == norm(t)]
        keep = max((j for j in group if j is not None), default=None)
        want.append((i, keep, len(group), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    for batches in (1, 2, 3):
        assert sorted(map(tuple, dedup(odd_docs, batches).collect()), key=repr) == sorted(want, key=repr)
    assert dedup(no_docs).count() == 0
