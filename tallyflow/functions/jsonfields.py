"""JSON field expressions (IDs C4-C8, C14, C15, F2, F3).

One parse per message: ``from_json`` into an explicit struct (with a corrupt
record column to route malformed rows), or ``try_parse_json`` into a VARIANT
when the JSON type of a value matters (strict mode).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def key_path(key: str) -> str:
    """Variant path for a top-level key: ``$['key']``, or ``$["key"]`` when
    the key holds a single quote (paths have no escape for quotes)."""
    if "'" not in key:
        return "$['" + key + "']"
    if '"' not in key:
        return '$["' + key + '"]'
    raise ValueError(f"key {key!r} holds both quote characters")


def parse_struct(col, schema: str) -> Column:
    """C4: parse a JSON object into ``schema`` plus ``_corrupt_record``.

    Values of another JSON type are coerced to a string field (``5`` ->
    ``"5"``); text that is not a JSON object, or a field that cannot be
    coerced (text in a long field), sets ``_corrupt_record``; an empty or
    null message gives a null struct.
    """
    return F.from_json(_c(col), f"{schema}, {CORRUPT} string",
                       {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})


def parse_variant(col) -> Column:
    """C4 keeping JSON types: VARIANT, null for malformed text."""
    return F.try_parse_json(_c(col))


def variant_field(v, key: str) -> Column:
    """Field of a parsed VARIANT object: SQL null when the key is absent,
    variant null when the key is present with JSON null."""
    return F.expr(f"variant_get({_sql(v)}, {sql_str(key_path(key))})")


def variant_field_string(v, key: str) -> Column:
    """Field as text; numbers and objects are rendered as JSON text."""
    return F.expr(f"try_variant_get({_sql(v)}, {sql_str(key_path(key))}, 'string')")


def variant_type(x) -> Column:
    """``STRING`` / ``VOID`` (JSON null) / ``BIGINT`` / ``OBJECT<..>`` ..."""
    return F.schema_of_variant(_c(x))


def nested_field(json_text, *keys: str) -> Column:
    """Walk JSON text nested in JSON text: each level is a string that
    holds JSON (or an object); returns the innermost value as text."""
    out = _c(json_text)
    for k in keys:
        out = F.get_json_object(out, "$." + k)
    return out


def null_to_zero(col) -> Column:
    """C8."""
    return F.coalesce(_c(col), F.lit(0).cast("long"))


def as_text(col) -> Column:
    """C14."""
    return _c(col).cast("string")


def parse_int(col) -> Column:
    """Integer parse that gives null instead of failing."""
    return _c(col).try_cast("int")


def _sql(col) -> str:
    if isinstance(col, str):
        return f"`{col}`"
    raise TypeError("pass a column name")


def sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
