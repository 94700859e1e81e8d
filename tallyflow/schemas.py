"""Explicit schemas of every relation. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# call_log message fields, as read by the parser. ``outputInfo`` is itself
# JSON text holding ``returnCode`` and ``meta`` (JSON text holding ``code``).
CALL_LOG_FIELDS = ("id string, date long, projectName string, clazz string, "
                   "method string, outputInfo string")

OUTPUT_INFO_FIELDS = "returnCode string, meta string"
META_FIELDS = "code string"

# a topic record / hash-store entry
TOPIC_RECORD = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

# requests: one argument string per call
REQUESTS = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("args", T.StringType()),
])

# Driver tables read by the queries, with their parquet types. Reading with
# an explicit schema skips the footer-reading schema-inference job and fails
# fast if a file's types change.
TABLE_SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
               "value double, props string"),
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "pages": "page_id bigint, url string, html string",
}
