"""The pipeline: stages in order, each one's decisions, odd tables, and the
whole against the operators' plain versions."""

import os

import pytest

import corpus_pipeline as cp
from tallyflow.llm import decontam, quality
from test_mixing import check
from test_partenum import brute
from odd_rows import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "token_files"]


def _tables(spark, path, docs):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "Minus five has words. Of its own too.")], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet")


def test_odd_rows(spark, odd_docs, no_docs, scratch):
    for name, docs in (("odd", odd_docs), ("none", no_docs)):
        _tables(spark, f"{scratch}/{name}", docs)
        rows = docs
        for k, (step, f) in enumerate(cp.STAGES):
            out = f"{scratch}/{name}-{k}"
            f(spark, rows, f"{scratch}/{name}").write.parquet(out)
            rows = spark.read.parquet(out)
            if step != "token_files":
                assert rows.columns == docs.columns
        assert (rows.count() > 0) == (name == "odd")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_each_stage_against_a_plain_version(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    after = []
    for k, (_, f) in enumerate(cp.STAGES):
        f(spark, docs, SF).write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
        after.append(sorted(docs.collect(), key=repr))
    start = spark.read.parquet(f"{SF}/documents.parquet")
    w = quality.train(start, spark.read.parquet(f"{SF}/labels.parquet"))
    of = quality.Features()
    good = [r for r in start.collect() if quality._sigmoid(float(w[of(r.text)[0]] @ of(r.text)[1])) >= 0.3]
    assert sorted(good, key=repr) == after[0]
    groups = brute([(r.doc_id, r.text) for r in after[0]], 5, 80)
    keep = {i for i, n, c in groups if n == 0 or i == c}
    assert [r for r in after[0] if r.doc_id in keep] == after[1]
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    leaks = {r.doc_id for r in after[1] if any(i.text in r.text for i in items)}
    assert [r for r in after[1] if r.doc_id not in leaks] == after[2] and leaks
    from tallyflow.llm import mixing
    plan = {r.doc_id: r for r in mixing.decisions(spark.read.parquet(f"{scratch}/2")).collect()}
    check([(r.source, r.text) for r in after[2]], [plan[r.doc_id] for r in after[2]], 60)
    assert after[3] == sorted((r for r in after[2] for _ in range(plan[r.doc_id].taken // plan[r.doc_id].size)), key=repr)
    assert len(after[4]) == len(after[3])
    assert sorted(r.doc_id for r in after[4]) == sorted(r.doc_id for r in after[3])
    assert decontam.leaks(spark.read.parquet(f"{scratch}/3"), spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
