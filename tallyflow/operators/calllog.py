"""Call-log parsing, key extraction and routing.

IDs: C3-C7, C9, C15 (fields), F2-F4 (filters), P1, P3, P8 (projection and
routing). One JSON parse per message; every output is a DataFrame derived
from the same parent, so a caller that writes several branches can
``persist()`` the parent (batch) or use one ``foreachBatch`` (stream) to read
the source once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow import schemas
from tallyflow.functions.jsonfields import (
    CORRUPT, key_path, parse_struct, parse_variant, sql_str, variant_field,
    variant_field_string, variant_type)
from tallyflow.functions.once import compute_once
from tallyflow.functions.timecols import to_event_time
from tallyflow.functions.tokens import last_token

PARSED_COLS = ("msg_id", "project_name", "class_name", "method_name", "ts_ms",
               "event_time", "output_info")

STRICT = "strict"   # JSON types checked: a non-text value reads as null / a reject
COERCE = "coerce"   # numbers and objects read as their JSON text

# output column -> message field, for the text fields of a call log
_TEXT_FIELDS = {"msg_id": "id", "project_name": "projectName", "_clazz": "clazz",
                "method_name": "method", "output_info": "outputInfo"}


def _parse(messages: DataFrame, value_col: str) -> DataFrame:
    staged = messages.select(F.col(value_col).alias("_value"))
    return compute_once(staged, parse_struct("_value", schemas.CALL_LOG_FIELDS).alias("_p"))


def _parse_strict(messages: DataFrame, value_col: str) -> DataFrame:
    """One VARIANT parse; text fields typed-checked, ``date`` integral."""
    staged = compute_once(messages.select(F.col(value_col).alias("_value")),
                          parse_variant("_value").alias("_v"))
    date = variant_field("_v", "date")
    cols = [F.when(variant_type(variant_field("_v", k)) == "STRING",
                   variant_field_string("_v", k)).alias(out) for out, k in _TEXT_FIELDS.items()]
    ok = (variant_type("_v").startswith("OBJECT")
          & (date.isNull() | (variant_type(date) == "BIGINT")))
    return staged.select("_value", ok.alias("_ok"), *cols,
                         F.expr("try_variant_get(_v, '$.date', 'bigint')").alias("_date"))


def parse_call_log(messages: DataFrame, value_col: str = "value",
                   time_type: str = "timestamp_ntz", mode: str = STRICT) -> DataFrame:
    """Call-log JSON -> ``split_by_name`` rows.

    Columns: ``msg_id`` (null when absent), ``project_name``, ``class_name``
    (last space token of ``clazz``), ``method_name``, ``ts_ms`` (``date``,
    0 when absent), ``event_time`` (from ``ts_ms``; TIMESTAMP_NTZ for batch,
    TIMESTAMP for streams) and ``output_info`` (JSON text or null).
    Malformed messages are left out; ``call_log_rejects`` returns them.

    ``strict`` (default): as the reference's parser, a text field holding
    another JSON type (or null) reads as null, and a ``date`` that is not an
    integer makes the message a reject. ``coerce``: one ``from_json``; a number
    or object in a text field reads as its JSON text.
    """
    if mode == STRICT:
        p = _parse_strict(messages, value_col).where("_ok")
        ts_ms = F.coalesce(F.col("_date"), F.lit(0).cast("long"))
        return p.select("msg_id", "project_name", last_token("_clazz").alias("class_name"),
                        "method_name", ts_ms.alias("ts_ms"),
                        to_event_time(ts_ms, time_type).alias("event_time"), "output_info")
    if mode != COERCE:
        raise ValueError(f"mode must be {STRICT!r} or {COERCE!r}")
    p = _parse(messages, value_col)
    ok = p.where(F.col("_p").isNotNull() & F.col(f"_p.{CORRUPT}").isNull())
    ts_ms = F.coalesce(F.col("_p.date"), F.lit(0).cast("long"))
    return ok.select(
        F.col("_p.id").alias("msg_id"),
        F.col("_p.projectName").alias("project_name"),
        last_token(F.col("_p.clazz")).alias("class_name"),
        F.col("_p.method").alias("method_name"),
        ts_ms.alias("ts_ms"),
        to_event_time(ts_ms, time_type).alias("event_time"),
        F.col("_p.outputInfo").alias("output_info"),
    )


def call_log_rejects(messages: DataFrame, value_col: str = "value",
                     mode: str = STRICT) -> DataFrame:
    """Messages that are not a parsable call-log object (in strict
    mode also those whose ``date`` is not an integer)."""
    if mode == STRICT:
        p = _parse_strict(messages, value_col)
        return p.where(F.col("_value").isNotNull() & ~F.coalesce("_ok", F.lit(False))) \
            .select(F.col("_value").alias(value_col))
    p = _parse(messages, value_col)
    bad = (F.col("_p").isNull() & F.col("_value").isNotNull()) | F.col(f"_p.{CORRUPT}").isNotNull()
    return p.where(bad).select(F.col("_value").alias(value_col))


def general_stream(parsed: DataFrame) -> DataFrame:
    """The dispatch step: drop ``msg_id`` and pass the four fields on."""
    return parsed.select("project_name", "class_name", "method_name", "ts_ms", "event_time")


def status_route(parsed: DataFrame) -> DataFrame:
    """Rows whose ``outputInfo.meta.code`` parses to integer 0.

    ``outputInfo`` is JSON text; its ``meta`` is JSON text holding ``code``.
    Rows with missing or unparsable fields are not routed.
    """
    info = F.from_json("output_info", schemas.OUTPUT_INFO_FIELDS)
    staged = compute_once(parsed.select(*PARSED_COLS), info.alias("_info"))
    meta = F.from_json(F.col("_info.meta"), schemas.META_FIELDS)
    staged = compute_once(staged, F.col("_info.returnCode").alias("return_code"),
                          meta["code"].alias("status_code"), keep=PARSED_COLS)
    return (staged.where(F.col("status_code").try_cast("int") == 0)
            .select("return_code", "status_code", "project_name", "class_name",
                    "method_name", "ts_ms", "event_time", "msg_id"))


def result_codes(parsed: DataFrame) -> DataFrame:
    """The result-code stream: ``outputInfo.returnCode`` with its time."""
    info = F.from_json("output_info", schemas.OUTPUT_INFO_FIELDS)
    return parsed.select(info["returnCode"].alias("return_code"), "ts_ms", "event_time", "msg_id")


def route(parsed: DataFrame) -> dict[str, DataFrame]:
    """Named sub-streams of one parsed input."""
    return {"general": general_stream(parsed), "status": status_route(parsed),
            "result_code": result_codes(parsed)}


def json_key_filter(messages: DataFrame, key: str, value_col: str = "value",
                    out_col: str | None = None, mode: str = STRICT,
                    keep: tuple[str, ...] = (),
                    fields: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """F2 + C5: keep JSON objects that contain ``key``; emit its value.

    The value may be JSON null (kept, null output). ``strict`` keeps only
    string or null values (another JSON type is rejected); ``coerce`` renders
    numbers and objects as JSON text. Non-objects and malformed text never
    pass; see ``json_key_rejects``. ``fields`` maps extra output columns to
    ``(json key, spark type)`` read from the same parse (null when absent or
    of another type).
    """
    out_col = out_col or key
    staged = messages.select(*keep, F.col(value_col).alias("_value"))
    staged = compute_once(staged, parse_variant("_value").alias("_v"))
    staged = staged.select(*keep, "_value", "_v", variant_field("_v", key).alias("_x"))
    present = F.col("_x").isNotNull()
    if mode == STRICT:
        cond = present & variant_type("_x").isin("STRING", "VOID")
    elif mode == COERCE:
        cond = present
    else:
        raise ValueError(f"mode must be {STRICT!r} or {COERCE!r}")
    extra = [F.expr(f"try_variant_get(_v, {sql_str(key_path(k))}, '{t}')").alias(c)
             for c, (k, t) in (fields or {}).items()]
    return staged.where(cond).select(
        *keep, F.col("_value").alias(value_col),
        variant_field_string("_v", key).alias(out_col), *extra)


def json_key_rejects(messages: DataFrame, key: str, value_col: str = "value",
                     mode: str = STRICT, keep: tuple[str, ...] = ()) -> DataFrame:
    """malformed text, non-objects, and (strict) non-string values.

    Objects without ``key`` are dropped silently, as in the reference, and
    are not rejects.
    """
    staged = compute_once(messages.select(*keep, F.col(value_col).alias("_value")),
                          parse_variant("_value").alias("_v"))
    x = variant_field("_v", key)
    not_object = ~variant_type("_v").startswith("OBJECT")
    bad = F.col("_value").isNotNull() & (F.col("_v").isNull() | not_object)
    if mode == STRICT:
        bad = bad | (x.isNotNull() & ~variant_type(x).isin("STRING", "VOID"))
    return staged.where(bad).select(*keep, F.col("_value").alias(value_col))
