"""Batch forms of the five jobs end to end, and the file sinks (K1, K4, K5,
P10, S6; FIXTURES.md A, B, D)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tallyflow.plans import jobs
from tallyflow.sinks.documents import index_documents, write_documents
from tallyflow.sinks.records import to_records, write_records
from tallyflow.sources.literal import literal_rows, request_strings
from tallyflow import schemas


def test_word_count_job(sentences):
    got = {r.word: r["count"] for r in jobs.word_count_batch(sentences).collect()}
    assert got["the"] == 4 and len(got) == 27


def test_log_rollup_job_and_document_sink(spark, call_log, scratch):
    docs = jobs.log_rollup_batch(call_log)
    assert {r._index for r in docs.select("_index").collect()} == {"logcount-2024.01.01"}
    out = os.path.join(scratch, "docs")
    write_documents(docs, out)
    write_documents(docs, out)      # a re-run leaves each document once
    back = spark.read.json(out)
    assert back.count() == 4
    assert os.path.isdir(os.path.join(out, "_index=logcount-2024.01.01"))
    assert {"project_name", "class_name", "method_name", "total_count", "timestamp", "_type",
            "@timestamp"} <= set(back.columns)


def test_index_day_from_write_time(call_log):
    docs = index_documents(jobs.log_rollup_batch(call_log).drop("_index", "_type", "@timestamp"),
                           day_col=None)
    r = docs.select("_index").first()
    assert r._index.startswith("logcount-") and len(r._index) == len("logcount-yyyy.MM.dd")


def test_rolling_job_with_ttl(call_log):
    # p1's last window ends at 00:00:20, p2's at 00:00:10: with a 5 s TTL only p1 lives
    as_of = F.lit(dt.datetime(2024, 1, 1, 0, 0, 21)).cast("timestamp_ntz")
    live = jobs.rolling_state_batch(call_log, length="10 seconds", ttl_seconds=5, as_of=as_of).collect()
    assert [(r.projectName, r["count"]) for r in live] == [("p1", 1)]


def test_word_lookup_job_miss(spark, sentences):
    state = jobs.word_state_batch(sentences)
    req = request_strings(spark, ["kafka"])
    assert jobs.word_lookup(req, state).count() == 0


def test_topic_records_and_sink(spark, sentences, scratch):
    # producer: sentences carry no key field, so the key is null (K4)
    recs = jobs.sentence_records(sentences)
    assert recs.where("key IS NULL").count() == 5
    # literal (word, count) text rows, shaped as FIXTURES.md B -> key = word, value = count (K5)
    rows = literal_rows(spark, "word string, count string",
                        [("alpha", "1"), ("beta", "1"), ("needs", "1"), ("docs", "1")])
    kv = jobs.word_count_records(rows)
    assert sorted(map(tuple, kv.collect())) == [("alpha", "1"), ("beta", "1"),
                                                ("docs", "1"), ("needs", "1")]
    out = os.path.join(scratch, "records")
    write_records(kv, path=out)
    back = spark.read.schema(schemas.TOPIC_RECORD).json(out)
    assert back.count() == 4 and set(back.columns) == {"key", "value"}


def test_to_records_casts(spark):
    df = spark.createDataFrame([("a", 3)], "word string, count long")
    r = to_records(df, "word", "count").first()
    assert (r.key, r.value) == ("a", "3")
