"""Command-line entry for the five jobs (the reference starts each from a
``main``). Also usable as the ``spark-submit`` script:

    python -m tallyflow word-count  --input DIR --output DIR [--stream]
    python -m tallyflow log-rollup  --input DIR --output DIR [--window 10s] [--stream]
    python -m tallyflow rolling     --input DIR --snapshot DIR [--window 1s] [--ttl 300] [--stream]
    python -m tallyflow lookup      --requests DIR --state-from word-count|snapshot --state DIR
                                    --output DIR [--miss drop|zero|null]
    python -m tallyflow records     --input DIR --output DIR [--key-col C] [--record-value-col C]

Inputs are folders of messages: ``--format text`` (one message per line,
the default), ``json`` or ``parquet`` with ``--value-col`` naming the
message column. Batch runs read the folder once; ``--stream`` watches it
(``--once`` processes what is there and stops). Outputs are parquet, except
the daily-index documents and topic records (JSON); the word-count stream
writes each micro-batch's changed counts to ``<output>/batch_id=N``,
overwritten if the batch is replayed. Checkpoints go under
``spark.checkpoint.dir`` unless ``--checkpoint`` is given.
"""

from __future__ import annotations

import argparse
import re
import sys

from pyspark.sql import DataFrame, SparkSession

from tallyflow.operators import lookup as lk
from tallyflow.operators import wordcount as wc
from tallyflow.plans import jobs
from tallyflow.session import get_session, sub_dir
from tallyflow.sinks.documents import write_documents
from tallyflow.sinks.records import to_records, write_records
from tallyflow.sources.streams import StreamSpec


def _length(s: str) -> str:
    """``10s`` / ``1m`` / ``2h`` / ``10 seconds`` -> a Spark interval string."""
    m = re.fullmatch(r"(\d+)\s*(s|m|h)", s.strip())
    if m:
        unit = {"s": "second", "m": "minute", "h": "hour"}[m.group(2)]
        return f"{m.group(1)} {unit}{'s' if m.group(1) != '1' else ''}"
    return s


def _read_batch(spark: SparkSession, a) -> DataFrame:
    if a.format == "text":
        return spark.read.text(a.input)
    r = spark.read.format(a.format)
    df = (r.schema(a.schema) if a.schema else r).load(a.input)
    return df.withColumnRenamed(a.value_col, "value") if a.value_col else df


def _spec(a) -> StreamSpec:
    return StreamSpec(path=a.input, file_format=a.format, schema=a.schema,
                      value_col=a.value_col, max_files_per_trigger=a.max_files)


def _trigger(a) -> dict:
    return {"availableNow": True} if a.once else {"processingTime": a.trigger}


def _ckpt(spark: SparkSession, a, name: str) -> str:
    return a.checkpoint or sub_dir(spark, f"ckpt/{name}")


def word_count(spark: SparkSession, a) -> None:
    if a.stream:
        out = a.output

        def sink(batch: DataFrame, batch_id: int) -> None:
            # changed counts of each micro-batch (update mode), one folder per
            # batch id, overwritten on replay: a retried batch is not doubled
            batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        jobs.word_count_stream(spark, _spec(a), _ckpt(spark, a, "word_count"), "update",
                               trigger=_trigger(a), foreach_batch=sink,
                               mode=a.split).awaitTermination()
        return
    lines = _read_batch(spark, a).withColumnRenamed("value", "line")
    counts = jobs.word_count_batch(lines) if a.split == wc.WHITESPACE else \
        jobs.word_state_batch(lines)
    counts.write.mode("overwrite").parquet(a.output)


def log_rollup(spark: SparkSession, a) -> None:
    if a.stream:
        jobs.log_rollup_stream(spark, _spec(a), a.output, _ckpt(spark, a, "log_rollup"),
                               _length(a.window), trigger=_trigger(a),
                               output_files=a.output_files).awaitTermination()
        return
    write_documents(jobs.log_rollup_batch(_read_batch(spark, a), _length(a.window)), a.output)


def rolling(spark: SparkSession, a) -> None:
    snap = jobs.rolling_snapshot(spark, a.snapshot, a.ttl)
    if a.stream:
        jobs.rolling_stream(spark, _spec(a), snap, _ckpt(spark, a, "rolling"),
                            _length(a.window), trigger=_trigger(a)).awaitTermination()
        return
    state = jobs.rolling_state_batch(_read_batch(spark, a), _length(a.window), None)
    last = (snap.versions() or [-1])[-1]
    snap.upsert(state.select("projectName", "count", "updated_at"), last + 1)


def lookup(spark: SparkSession, a) -> None:
    requests = spark.read.schema("request_id long, args string").json(a.requests)
    if a.state_from == "word-count":
        state = jobs.word_state_from_stream(spark, a.state)
        out = jobs.word_lookup(requests, state, a.miss)
    else:
        snap = jobs.rolling_snapshot(spark, a.state, a.ttl)
        out = jobs.rolling_lookup(requests, snap.read(), a.miss)
    out.write.mode("overwrite").parquet(a.output)


def records(spark: SparkSession, a) -> None:
    df = _read_batch(spark, a)
    write_records(to_records(df, a.key_col, a.record_value_col), path=a.output)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallyflow")
    p.add_argument("--master", default=None)
    p.add_argument("--profile", default="local", choices=["local", "cluster"])
    sub = p.add_subparsers(dest="job", required=True)

    def common(sp, stream=True):
        sp.add_argument("--input", required=True)
        sp.add_argument("--format", default="text", choices=["text", "json", "parquet"])
        sp.add_argument("--value-col", default=None)
        sp.add_argument("--schema", default=None, help="DDL schema for json/parquet streams")
        if stream:
            sp.add_argument("--stream", action="store_true")
            sp.add_argument("--once", action="store_true")
            sp.add_argument("--trigger", default="10 seconds")
            sp.add_argument("--max-files", type=int, default=None)
            sp.add_argument("--checkpoint", default=None)

    sp = sub.add_parser("word-count")
    common(sp)
    sp.add_argument("--output", required=True)
    sp.add_argument("--split", default=wc.WHITESPACE, choices=[wc.WHITESPACE, wc.SPACE],
                    help="whitespace runs (word-count job) or single spaces (look-up state)")
    sp = sub.add_parser("log-rollup")
    common(sp)
    sp.add_argument("--output", required=True)
    sp.add_argument("--window", default="10s")
    sp.add_argument("--output-files", type=int, default=None,
                    help="stream: at most this many files per micro-batch and day")
    sp = sub.add_parser("rolling")
    common(sp)
    sp.add_argument("--snapshot", required=True)
    sp.add_argument("--window", default="1s")
    sp.add_argument("--ttl", type=int, default=jobs.ROLL_TTL_SECONDS)
    sp = sub.add_parser("lookup")
    sp.add_argument("--requests", required=True)
    sp.add_argument("--state-from", required=True, choices=["word-count", "snapshot"])
    sp.add_argument("--state", required=True)
    sp.add_argument("--output", required=True)
    sp.add_argument("--miss", default=lk.DROP, choices=[lk.DROP, lk.ZERO, lk.NULL])
    sp.add_argument("--ttl", type=int, default=jobs.ROLL_TTL_SECONDS)
    sp = sub.add_parser("records")
    common(sp, stream=False)
    sp.add_argument("--output", required=True)
    sp.add_argument("--key-col", default=None)
    sp.add_argument("--record-value-col", default="value")
    return p


JOBS = {"word-count": word_count, "log-rollup": log_rollup, "rolling": rolling,
        "lookup": lookup, "records": records}


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = get_session(a.master, profile=a.profile)
    JOBS[a.job](spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
