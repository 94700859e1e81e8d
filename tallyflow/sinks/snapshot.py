"""Keyed state kept as a versioned snapshot table.

Plain parquet has no MERGE, so each upsert writes a complete new version
``<path>/batch_id=N`` = latest row per key over (version N-1 + new rows). The
small file ``_versions`` names the committed versions; it is replaced (by a
rename) after a version's data is written, so readers see a version whole or
not at all, with one small read whatever the number of past batches. A
replayed ``batch_id`` recomputes from version N-1 and overwrites its own
folder, so a retried micro-batch leaves the table unchanged (idempotent, T8).
The written version also cuts lineage between batches. Only the newest
``retain`` versions are kept.

Each version rewrites the whole state: size it for bounded key sets (the
rolling job's projects). For a large keyed state (all words) keep the counts
in the stream's state store and read them with
``tallyflow.streaming.state.read_state``.

Expiry runs on the time of writing, kept per key: by default against the
current time, or against an explicit ``now`` / ``as_of``. With
``ttl_scope="table"`` the whole snapshot expires together, as a hash store
expires a hash: once nothing was written for the TTL it reads as empty and the
next upsert starts from nothing; each write starts the time again. With
``"key"`` each key expires by its own last write.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.operators.state import KEY, TABLE

_VERSIONS = "_versions"
_WRITTEN = "_written_at"


class KeyedSnapshot:
    """Latest value per key, versioned by batch id, on a shared filesystem."""

    def __init__(self, spark: SparkSession, path: str, key_cols: tuple[str, ...],
                 value_cols: tuple[str, ...], order_col: str = "updated_at",
                 ttl_seconds: int | None = None, ttl_scope: str = TABLE,
                 retain: int = 3, schema: str | None = None):
        """``retain``: how many committed versions are kept (2 at least, so a
        replay of the latest batch finds its base). ``schema``: the columns an
        empty snapshot reads as (default: text keys, long values, a time)."""
        if retain < 2:
            raise ValueError("retain must be at least 2")
        if ttl_scope not in (KEY, TABLE):
            raise ValueError(f"ttl_scope must be {KEY!r} or {TABLE!r}")
        self.spark, self.path = spark, path.rstrip("/")
        self.key_cols, self.value_cols, self.order_col = tuple(key_cols), tuple(value_cols), order_col
        self.ttl_seconds, self.ttl_scope, self.retain = ttl_seconds, ttl_scope, retain
        self.schema = schema or ", ".join([*(f"{c} string" for c in key_cols), *(f"{c} long" for c in value_cols),
                                           f"{order_col} timestamp"])

    # -- versions ---------------------------------------------------------
    def _hadoop(self, name: str):
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.path, name)
        return jvm, conf, path, path.getFileSystem(conf)

    def versions(self) -> list[int]:
        """Committed versions, ascending (the newest ``retain`` of them)."""
        jvm, _, path, fs = self._hadoop(_VERSIONS)
        if not fs.exists(path):
            return []
        f = fs.open(path)
        try:
            return [int(x) for x in re.findall(r"\d+", jvm.org.apache.commons.io.IOUtils.toString(f, "UTF-8"))]
        finally:
            f.close()

    def _commit(self, versions: list[int]) -> None:
        """Replace the version file in one step."""
        jvm, conf, path, fs = self._hadoop(_VERSIONS)
        new = jvm.org.apache.hadoop.fs.Path(self.path, _VERSIONS + ".new")
        out = fs.create(new, True)
        out.write(bytearray(" ".join(map(str, versions)).encode()))
        out.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf).rename(new, path, how)

    def _version_path(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    # -- read / write -----------------------------------------------------
    def _live(self, df: DataFrame, as_of: Column) -> DataFrame:
        if self.ttl_seconds is None:
            return df
        cutoff = as_of - F.expr(f"INTERVAL '{int(self.ttl_seconds)}' SECOND")
        written = F.col(_WRITTEN) if self.ttl_scope == KEY else df.select(F.max(_WRITTEN)).scalar()
        return df.where(written > cutoff)

    def _stored(self, before: int | None) -> DataFrame | None:
        vs = [v for v in self.versions() if before is None or v < before]
        return self.spark.read.parquet(self._version_path(vs[-1])) if vs else None

    def read(self, before: int | None = None, as_of: dt.datetime | None = None) -> DataFrame:
        """The greatest committed version (below ``before`` if given) without
        what has expired ``as_of`` (default: now). Empty when there is none."""
        df = self._stored(before)
        if df is None:
            return self.spark.createDataFrame([], self.schema)
        return self._live(df, F.current_timestamp() if as_of is None else _time(as_of)).drop(_WRITTEN)

    def upsert(self, batch_df: DataFrame, batch_id: int, now: dt.datetime | None = None) -> None:
        """Merge one batch of ``key_cols + value_cols + order_col`` rows.

        What has expired ``now`` (default: the current time) is dropped first.
        Per key the row with the greatest ``order_col`` wins; of equal ones a
        new row wins over the stored one (``combine(a, b) = b``), and among new
        rows the one with the greatest values. A batch without rows is not a
        write: it refreshes no expiry.
        """
        now = _time(now or dt.datetime.now(dt.timezone.utc))
        cols = [*self.key_cols, *self.value_cols, self.order_col]
        new = batch_df.select(*cols).withColumn(_WRITTEN, now)
        prev = self._stored(batch_id)
        if prev is not None:
            # keep the stored types (e.g. a stream's TIMESTAMP rows into a
            # snapshot first written by a batch job with TIMESTAMP_NTZ)
            types = dict(prev.dtypes)
            new = new.select(*[F.col(c).cast(types[c]).alias(c) for c in new.columns])
            prev = self._live(prev, now)
        merged = new.withColumn("_new", F.lit(1))
        if prev is not None:
            merged = prev.withColumn("_new", F.lit(0)).unionByName(merged)
        value = F.struct(*self.value_cols)
        latest = merged.groupBy(*self.key_cols).agg(
            F.max(F.struct(F.col(self.order_col).alias("o"), "_new", value.alias("v"))).alias("_b"),
            F.max(_WRITTEN).alias(_WRITTEN))
        out = latest.select(*self.key_cols, *[F.col(f"_b.v.{c}").alias(c) for c in self.value_cols],
                            F.col("_b.o").alias(self.order_col), _WRITTEN)
        out.write.mode("overwrite").parquet(self._version_path(batch_id))
        kept = [v for v in self.versions() if v < batch_id] + [batch_id]
        self._commit(kept[-self.retain:])
        for v in kept[:-self.retain]:
            jvm, _, path, fs = self._hadoop(f"batch_id={v}")
            fs.delete(path, True)

    def foreach_batch(self):
        """A ``writeStream.foreachBatch`` function performing ``upsert``."""
        def _fn(df: DataFrame, batch_id: int) -> None:
            self.upsert(df, batch_id)
        return _fn


def _time(t: dt.datetime) -> Column:
    """A point in time (naive: UTC) as a TIMESTAMP literal."""
    t = t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit(round(t.timestamp() * 1_000_000)))
