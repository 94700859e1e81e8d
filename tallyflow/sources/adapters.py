"""Adapters from the driver tables to the reference's message shapes.

* ``documents.text``   -> ``raw_line`` (one text message per document)
* ``events``           -> ``call_log`` JSON messages. The message is really
  encoded as JSON text and parsed again by the operators, so the JSON path
  runs on every row.
* ``conversations``    -> ``requests`` (one argument string per turn)

Adapter rule for ``call_log`` (fixed values, used by the queries and their
SQL oracles alike):

    id          = event_id as text
    date        = epoch milliseconds of ts
    projectName = 'p' || user_id % 5
    clazz       = 'class com.x.' || event_type
    method      = 'm' || k % 3            (k from props {"k": n})
    outputInfo  = {"returnCode": '1000' || user_id % 3,
                   "meta": {"code": '1' for event_type 'error' else '0'}}
                  with outputInfo and meta each encoded as JSON text
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.timecols import ntz_to_millis

# Fixed values of the call-log adapter rule.
PROJECT_PREFIX = "p"
PROJECT_MODULUS = 5
CLASS_PREFIX = "class com.x."
METHOD_PREFIX = "m"
METHOD_MODULUS = 3
RETURN_CODE_PREFIX = "1000"
RETURN_CODE_MODULUS = 3
ERROR_EVENT = "error"


def lines(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """raw_line: ``(doc_id, line)``."""
    return documents.select("doc_id", F.col(text_col).alias("line"))


def call_log_fields() -> dict:
    """The message's fields as columns of ``events``, in their order."""
    k = F.get_json_object("props", "$.k").cast("long")
    meta = F.to_json(F.struct(
        F.when(F.col("event_type") == ERROR_EVENT, F.lit("1"))
         .otherwise(F.lit("0")).alias("code")))
    output_info = F.to_json(F.struct(
        F.concat(F.lit(RETURN_CODE_PREFIX),
                 (F.col("user_id") % RETURN_CODE_MODULUS).cast("string")).alias("returnCode"),
        meta.alias("meta")))
    return {
        "id": F.col("event_id").cast("string"),
        "date": ntz_to_millis("ts"),
        "projectName": F.concat(F.lit(PROJECT_PREFIX), (F.col("user_id") % PROJECT_MODULUS).cast("string")),
        "clazz": F.concat(F.lit(CLASS_PREFIX), F.col("event_type")),
        "method": F.concat(F.lit(METHOD_PREFIX), (k % METHOD_MODULUS).cast("string")),
        "outputInfo": output_info,
    }


def call_log_messages(events: DataFrame) -> DataFrame:
    """call_log topic: ``(value)`` JSON text per event."""
    return events.select(F.to_json(F.struct(*[v.alias(k) for k, v in call_log_fields().items()])).alias("value"))


# Fixed values of the mixed-message rule: what is wrong with an event's
# message, by event_id modulo 7 (other remainders: nothing).
FAULT_MODULUS = 7
NO_DATE, NO_ID, NO_CLASS, NUMBER_PROJECT, TEXT_DATE = 0, 1, 2, 3, 4


def mixed_messages(events: DataFrame, pages: DataFrame, conversations: DataFrame) -> DataFrame:
    """``(value)``: call-log messages of which some lack a field or hold one of
    another type (the rule above), amid ``events.props`` objects, raw web pages
    and conversation turns."""
    fault = F.col("event_id") % FAULT_MODULUS
    good = call_log_fields()
    fields = {k: v for k, v in good.items() if k not in ("date", "projectName")}
    fields["id"] = F.when(fault != NO_ID, good["id"])
    fields["clazz"] = F.when(fault != NO_CLASS, good["clazz"])

    def message(date, project):
        return F.to_json(F.struct(*[v.alias(k) for k, v in
                                    {**fields, "date": date, "projectName": project}.items()]))

    value = (F.when(fault == NO_DATE, message(F.lit(None).cast("long"), good["projectName"]))
             .when(fault == NUMBER_PROJECT, message(good["date"], F.col("user_id") % PROJECT_MODULUS))
             .when(fault == TEXT_DATE, message(F.lit("not a date"), good["projectName"]))
             .otherwise(message(good["date"], good["projectName"])))
    return (events.select(value.alias("value")).unionByName(events.select(F.col("props").alias("value")))
            .unionByName(pages.select(F.col("html").alias("value")))
            .unionByName(conversations.select(F.col("text").alias("value"))))


def requests(conversations: DataFrame) -> DataFrame:
    """requests: ``(conv_id, turn, args)``, one request per turn."""
    return conversations.select("conv_id", "turn", F.col("text").alias("args"))
