"""tallyflow: word and call-log counting on Spark DataFrames and Structured Streaming.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, so Catalyst plans it (pruning, pushdown, partial aggregation) and
the same function serves batch and streaming input wherever Spark allows.

Layout
------
functions/  column expressions (tokenising, JSON fields, time columns)
sources/    table loaders, message adapters, literal rows, stream readers
operators/  word count, call-log parsing and routing, windowed counts,
            keyed latest state, look-ups, top-N
sinks/      daily-index documents, key/value records, keyed snapshots
streaming/  stream forms: running counts, watermarked windows, TTL state
plans/      the reference's five jobs as compositions, the query catalog
"""

from tallyflow.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
