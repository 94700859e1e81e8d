"""The command-line entry runs each job on staged message folders."""

import json
import os

from tallyflow.__main__ import main

from conftest import CALL_LOG_D, SENTENCES, call_log_json


def _stage(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_word_count_and_records(spark, scratch):
    src = os.path.join(scratch, "text")
    _stage(src, "a.txt", SENTENCES)
    main(["word-count", "--input", src, "--output", os.path.join(scratch, "wc")])
    got = {r.word: r["count"] for r in spark.read.parquet(os.path.join(scratch, "wc")).collect()}
    assert got["the"] == 4 and len(got) == 27
    main(["records", "--input", src, "--output", os.path.join(scratch, "rec")])
    back = spark.read.schema("key string, value string").json(os.path.join(scratch, "rec"))
    assert back.count() == 5 and back.where("key IS NULL").count() == 5


def test_log_rollup_batch_and_stream(spark, scratch):
    src = os.path.join(scratch, "logs")
    _stage(src, "a.txt", CALL_LOG_D + [call_log_json("S", 400_000, "px", "class z.Z", "mz")])
    main(["log-rollup", "--input", src, "--output", os.path.join(scratch, "docs")])
    batch = spark.read.json(os.path.join(scratch, "docs"))
    main(["log-rollup", "--input", src, "--output", os.path.join(scratch, "docs_s"),
          "--stream", "--once", "--checkpoint", os.path.join(scratch, "ck"), "--output-files", "1"])
    stream = spark.read.json(os.path.join(scratch, "docs_s"))
    cols = ["project_name", "class_name", "method_name", "total_count"]
    # the stream leaves the sentinel's window open; the batch emits it
    assert {tuple(r) for r in stream.select(*cols).collect()} == \
        {tuple(r) for r in batch.where("project_name <> 'px'").select(*cols).collect()}


def test_rolling_then_lookup(spark, scratch):
    src, snap = os.path.join(scratch, "logs"), os.path.join(scratch, "snap")
    _stage(src, "a.txt", CALL_LOG_D)
    main(["rolling", "--input", src, "--snapshot", snap, "--window", "10s", "--ttl", "1000000000"])
    req = os.path.join(scratch, "req")
    _stage(req, "r.json", [json.dumps({"request_id": 1, "args": "p1 zz p2"})])
    main(["lookup", "--requests", req, "--state-from", "snapshot", "--state", snap,
          "--output", os.path.join(scratch, "ans"), "--miss", "null", "--ttl", "1000000000"])
    got = sorted((r.pos, r.projectName, r["count"])
                 for r in spark.read.parquet(os.path.join(scratch, "ans")).collect())
    assert got == [(0, "p1", "1"), (1, "zz", None), (2, "p2", "1")]


def test_word_count_stream_batches_idempotent(spark, scratch):
    src, out, ck = (os.path.join(scratch, d) for d in ("text", "wc", "ck"))
    _stage(src, "a.txt", SENTENCES)
    args = ["word-count", "--input", src, "--output", out, "--stream", "--once", "--checkpoint", ck]
    main(args)
    back = spark.read.parquet(out)   # partition column batch_id from the folder names
    assert back.where("batch_id = 0").count() == 27
    assert {r.word: r["count"] for r in back.collect()}["the"] == 4
