"""K4 / K5 / K7 / K8: key/value record sinks (topic records).

``to_records`` is the field-name mapper (P10): any key and message column
become string ``key`` / ``value``. A missing key field gives a null key, as
the reference's producer does when its rows carry no ``key`` field.
``write_records`` writes files (JSON lines) or a Kafka topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def to_records(df: DataFrame, key_col: str | None, value_col: str) -> DataFrame:
    key = F.col(key_col).cast("string") if key_col and key_col in df.columns \
        else F.lit(None).cast("string")
    return df.select(key.alias("key"), F.col(value_col).cast("string").alias("value"))


def write_records(records: DataFrame, path: str | None = None, topic: str | None = None,
                  bootstrap_servers: str | None = None, mode: str = "append") -> None:
    """Batch write: Kafka when ``topic`` is given, else JSON lines at ``path``."""
    if topic:
        (records.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("topic", topic).save())
    else:
        records.write.mode(mode).json(path)


def append_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Append one micro-batch's rows as state, in a folder of its own
    (``batch_id=<id>``): a replayed batch replaces its folder, earlier batches
    stay. Readers see one table with the column ``batch_id``."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_records_stream(records: DataFrame, checkpoint: str, path: str | None = None,
                         topic: str | None = None, bootstrap_servers: str | None = None,
                         output_mode: str = "append",
                         trigger: dict | None = None,
                         output_files: int | None = None) -> StreamingQuery:
    """Stream write. ``output_mode="update"`` emits each changed count (K8);
    file sinks take append only. ``output_files`` coalesces each micro-batch
    to at most that many files. The file sink is exactly-once (sink log); the
    Kafka sink is at-least-once, so a replayed batch may repeat records, as
    the reference's producer could."""
    if output_files:
        records = records.coalesce(output_files)
    w = records.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if topic:
        return (w.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
                .option("topic", topic).start())
    return w.format("json").start(path)
