"""Query catalog: every registered query and its DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the whole driver
tables (no row caps, id subsets or prefixes). Every computed column is
aliased identically in the Spark code and in the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyflow.plans import oracle as O
from tallyflow.plans import queries as Q

# name -> (query, oracle SQL or None for a rows-only check)
_ENTRIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    # words: J-WC, J-DRPC, J-KTEST
    "word_count_space": (Q.word_count_space, O.WORD_COUNT_SPACE),
    "word_count_ws": (Q.word_count_ws, O.WORD_COUNT_WS),
    "sentence_records": (Q.sentence_records, O.SENTENCE_RECORDS),
    "topic_records": (Q.topic_records, O.TOPIC_RECORDS),
    "top_words": (Q.top_words, O.TOP_WORDS),
    "lookup_drop": (Q.lookup_drop, O.LOOKUP_DROP),
    "lookup_zero": (Q.lookup_zero, O.LOOKUP_ZERO),
    "lookup_null": (Q.lookup_null, O.LOOKUP_NULL),
    "lookup_identity": (Q.lookup_identity, O.LOOKUP_IDENTITY),
    "exclaim_n": (Q.exclaim_n, O.EXCLAIM_N),
    # call logs: J-LOG
    "parse_call_log": (Q.parse_call_log, O.PARSE_CALL_LOG),
    "parse_call_log_strict": (Q.parse_call_log_strict, O.PARSE_CALL_LOG_STRICT),
    "json_key_filter": (Q.json_key_filter, O.JSON_KEY_FILTER),
    "json_key_strict": (Q.json_key_strict, O.JSON_KEY_STRICT),
    "json_rejects": (Q.json_rejects, O.JSON_REJECTS),
    "status_route": (Q.status_route, O.STATUS_ROUTE),
    "window_count_by_name": (Q.window_count_by_name, O.WINDOW_COUNT_BY_NAME),
    "window_count_class": (Q.window_count_class, O.WINDOW_COUNT_CLASS),
    "sliding_count": (Q.sliding_count, O.SLIDING_COUNT),
    "sliding_count_new": (Q.sliding_count_new, O.SLIDING_COUNT_NEW),
    "hierarchical_count": (Q.hierarchical_count, O.HIERARCHICAL_COUNT),
    "hierarchical_count_10s": (Q.hierarchical_count_10s, O.HIERARCHICAL_COUNT_10S),
    "conditional_counts": (Q.conditional_counts, O.CONDITIONAL_COUNTS),
    "window_total": (Q.window_total, O.WINDOW_TOTAL),
    "window_last_key": (Q.window_last_key, O.WINDOW_LAST_KEY),
    "pack_map": (Q.pack_map, O.PACK_MAP),
    "pack_list": (Q.pack_list, O.PACK_LIST),
    "index_documents": (Q.index_documents, O.INDEX_DOCUMENTS),
    "rolling_top_n": (Q.rolling_top_n, O.ROLLING_TOP_N),
    "rolling_top_users": (Q.rolling_top_users, O.ROLLING_TOP_USERS),
    "rank_latest": (Q.rank_latest, O.RANK_LATEST),
    # rolling project counts: J-ROLL
    "window_count_project": (Q.window_count_project, O.WINDOW_COUNT_PROJECT),
    "latest_per_key": (Q.latest_per_key, O.LATEST_PER_KEY),
    "latest_with_ttl": (Q.latest_with_ttl, O.LATEST_WITH_TTL),
    "hash_store_records": (Q.hash_store_records, O.HASH_STORE_RECORDS),
    "project_lookup_null": (Q.project_lookup_null, O.PROJECT_LOOKUP_NULL),
    "state_ttl_key": (Q.state_ttl_key, O.STATE_TTL_KEY),
    "state_ttl_table": (Q.state_ttl_table, O.STATE_TTL_TABLE),
    "window_count_project_1s": (Q.window_count_project_1s, O.WINDOW_COUNT_PROJECT_1S),
    "window_last_key_1s": (Q.window_last_key_1s, O.WINDOW_LAST_KEY_1S),
    # windows whose slide does not divide their length, dispatch, ranking store
    "hierarchical_new": (Q.hierarchical_new, O.HIERARCHICAL_NEW),
    "conditional_new": (Q.conditional_new, O.CONDITIONAL_NEW),
    "general_stream": (Q.general_stream, O.GENERAL_STREAM),
    "ranking_store": (Q.ranking_store, O.RANKING_STORE),
    # messages that can fail
    "mixed_parse_strict": (Q.mixed_parse_strict, O.MIXED_PARSE_STRICT),
    "mixed_parse_coerce": (Q.mixed_parse_coerce, O.MIXED_PARSE_COERCE),
    "mixed_rejects_strict": (Q.mixed_rejects_strict, O.MIXED_REJECTS),
    "mixed_rejects_coerce": (Q.mixed_rejects_coerce, O.MIXED_REJECTS),
    "mixed_key_strict": (Q.mixed_key_strict, O.MIXED_KEY_STRICT),
    "mixed_key_coerce": (Q.mixed_key_coerce, O.MIXED_KEY_COERCE),
    "mixed_identity": (Q.mixed_identity, O.MIXED_IDENTITY),
    # streams run whole over the tables
    "stream_word_state": (Q.stream_word_state, O.WORD_COUNT_SPACE),
    "stream_word_changes": (Q.stream_word_changes, O.WORD_COUNT_SPACE),
    "stream_log_rollup": (Q.stream_log_rollup, O.STREAM_LOG_ROLLUP),
    "stream_window_rows": (Q.stream_window_rows, O.STREAM_WINDOW_ROWS),
    "stream_keyed_store": (Q.stream_keyed_store, O.STREAM_KEYED_STORE),
    # streams of several micro-batches
    "stream_kept_windows": (Q.stream_kept_windows, O.STREAM_KEPT_WINDOWS),
    "stream_late_rows": (Q.stream_late_rows, O.STREAM_LATE_ROWS),
    "stream_state_changes": (Q.stream_state_changes, O.STREAM_STATE_CHANGES),
    "stream_rate_limit": (Q.stream_rate_limit, O.STREAM_RATE_LIMIT),
    "stream_merge_store": (Q.stream_merge_store, O.STREAM_MERGE_STORE),
    # a ranking that batches update
    "ranking_updates": (Q.ranking_updates, O.RANKING_UPDATES),
    "ranking_of_requests": (Q.ranking_of_requests, O.RANKING_OF_REQUESTS),
    # look-ups that open the requested part of a store, and as of a time
    "store_lookup_words": (Q.store_lookup_words, O.STORE_LOOKUP_WORDS),
    "store_lookup_projects": (Q.store_lookup_projects, O.STORE_LOOKUP_PROJECTS),
    "as_of_lookup": (Q.as_of_lookup, O.AS_OF_LOOKUP),
    # windows made of panes
    "sliding_changes": (Q.sliding_changes, O.SLIDING_CHANGES),
    "sliding_by_name": (Q.sliding_by_name, O.SLIDING_BY_NAME),
    # documents written or refused
    "index_written": (Q.index_written, O.INDEX_WRITTEN),
    "index_refused": (Q.index_refused, O.INDEX_REFUSED),
    "observed_rows": (Q.observed_rows, O.OBSERVED_ROWS),
    "write_time_stamp": (Q.write_time_stamp, O.WRITE_TIME_STAMP),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    k: fn for k, (fn, _) in _ENTRIES.items()}
ORACLE_SQL: dict[str, str] = {k: sql for k, (_, sql) in _ENTRIES.items() if sql}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
