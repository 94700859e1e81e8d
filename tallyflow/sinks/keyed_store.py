"""A keyed store that is merged on reading (latest value per key).

Each batch writes only its own keys. The store is a *base* and a few *deltas*,
all laid out alike: one folder per hash bucket of the key, in it Parquet files
sorted by key (the base's with a Bloom filter on the first key column). The file
``_manifest`` names the folders that make up the store and is replaced in one
step after their data is written, so readers see a batch whole or not at all,
and a crash leaves at most a folder that nothing names.

* ``upsert`` reduces a batch to one row per key and writes it as a delta: the
  bytes written follow the batch, not the state. Batch ids ascend; a batch id
  that is not above the last of its ``writer`` is a replay and changes nothing.
* Compaction keeps reads cheap. With ``max_deltas`` deltas they are merged into
  one; once the deltas reach ``growth`` times the base's bytes they are merged
  into a new base. A key is so rewritten a bounded number of times for each
  doubling of the store. Folders that a compaction replaces are deleted by the
  next one, so a reader that still has them open can finish.
* ``read`` merges base and deltas: per key at most one row of each.
* ``read_keys`` does so for requested keys: it opens only the bucket folders
  they hash to and, for up to ``LISTED_KEYS`` keys, hands the keys down to the
  Parquet scan, which skips row groups by range and Bloom filter.

The value of a key is that of its greatest ``order_col`` (null is least); of
equal ones the later batch wins, within a batch the greatest values. Expiry
runs on the time of writing, as in ``tallyflow.sinks.snapshot``: with
``ttl_scope="table"`` the store reads as empty, and starts from nothing, once
nothing was written for the TTL (kept in the manifest); with ``"key"`` a key
expires by its own last write, and a key written again after that starts anew.
A batch without rows is not a write. Null keys are keys.
"""

from __future__ import annotations

import copy
import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.operators.state import KEY, TABLE
from tallyflow.sinks import textfile

MANIFEST = "_manifest"
BUCKET = "_bucket"
FIRST, LAST, SEQ = "_first_write", "_last_write", "_seq"     # microseconds, microseconds, number of the commit

# Up to this many requested keys are handed down to the scan.
LISTED_KEYS = 1000

EMPTY = {"base": None, "deltas": [], "trash": [], "seq": 0, "writers": {}, "last_write": None}


class KeyedStore:
    """Latest value per key on a shared file system, merged on reading."""

    def __init__(self, spark: SparkSession, path: str, key_cols: tuple[str, ...], value_cols: tuple[str, ...],
                 order_col: str = "updated_at", ttl_seconds: int | None = None, ttl_scope: str = TABLE,
                 buckets: int = 64, max_deltas: int = 8, growth: float = 0.5, schema: str | None = None):
        """``buckets`` counts when the store is made; an existing one keeps its
        own. ``schema``: the columns an empty store reads as (default: text
        keys, long values, a time)."""
        if ttl_scope not in (KEY, TABLE):
            raise ValueError(f"ttl_scope must be {KEY!r} or {TABLE!r}")
        if max_deltas < 2 or buckets < 1:
            raise ValueError("max_deltas must be at least 2, buckets at least 1")
        self.spark, self.path = spark, path.rstrip("/")
        self.key_cols, self.value_cols, self.order_col = tuple(key_cols), tuple(value_cols), order_col
        self.ttl_us = None if ttl_seconds is None else int(ttl_seconds) * 1_000_000
        self.ttl_scope, self.buckets, self.max_deltas, self.growth = ttl_scope, buckets, max_deltas, growth
        self.schema = schema or ", ".join([*(f"{c} string" for c in key_cols), *(f"{c} long" for c in value_cols),
                                           f"{order_col} timestamp"])

    # -- manifest ------------------------------------------------------------
    def manifest(self) -> dict:
        text = textfile.read_text(self.spark, self.path, MANIFEST)
        return json.loads(text) if text else {**copy.deepcopy(EMPTY), "buckets": self.buckets}

    def _commit(self, m: dict) -> None:
        textfile.replace_text(self.spark, self.path, MANIFEST, json.dumps(m))

    # -- rows ------------------------------------------------------------------
    @property
    def _cols(self) -> list[str]:
        return [*self.key_cols, *self.value_cols, self.order_col]

    def _bucket(self, m: dict) -> Column:
        return F.pmod(F.xxhash64(*self.key_cols), F.lit(m["buckets"])).cast("int")

    def _write(self, rows: DataFrame, m: dict, name: str) -> dict:
        """Write a folder of rows (columns of the store, one per key). Only a
        base has Bloom filters: one takes 64 KB at least, more than a small
        delta."""
        (rows.withColumn(BUCKET, self._bucket(m)).repartition(BUCKET).sortWithinPartitions(BUCKET, *self.key_cols)
         .write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{self.key_cols[0]}", name.startswith("base"))
         .option("parquet.bloom.filter.adaptive.enabled", True)
         .partitionBy(BUCKET).parquet(f"{self.path}/{name}"))
        return {"name": name, "bytes": textfile.data_bytes(self.spark, self.path, name)}

    def folders(self, m: dict) -> list[dict]:
        return [*([m["base"]] if m["base"] else []), *m["deltas"]]

    def _rows(self, m: dict, folders: list[dict], buckets: list[int] | None = None,
              keys: list | None = None) -> DataFrame:
        """The rows of base and deltas, unmerged; of some buckets and keys."""
        schema = T.StructType.fromJson(m["schema"]).add(BUCKET, T.IntegerType())
        out = None
        for f in folders:
            df = self.spark.read.schema(schema).parquet(f"{self.path}/{f['name']}")
            if buckets is not None:
                df = df.where(F.col(BUCKET).isin(buckets))
            if keys is not None:
                key = F.col(self.key_cols[0])
                asked = key.isin([k for k in keys if k is not None])
                df = df.where(asked | key.isNull() if None in keys else asked)
            out = df if out is None else out.unionByName(df)
        return out.drop(BUCKET)

    def _merged(self, rows: DataFrame, folders: int) -> DataFrame:
        """One row per key."""
        if folders < 2:
            return rows
        row = F.struct(SEQ, FIRST, LAST, F.col(self.order_col).alias("o"), F.struct(*self.value_cols).alias("v"))
        if self.ttl_us is None or self.ttl_scope == TABLE:
            best = F.max(F.struct(F.col(self.order_col).alias("o"), SEQ, F.struct(*self.value_cols).alias("v")))
            merged = rows.groupBy(*self.key_cols).agg(best.alias("_b"), F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST))
        else:       # a key's rows, at most one per folder, in order of writing
            writes = F.array_sort(F.collect_list(row))
            folded = F.aggregate(F.slice("_w", 2, F.size("_w")), F.get("_w", F.lit(0)), self._later)
            merged = (rows.groupBy(*self.key_cols).agg(writes.alias("_w")).withColumn("_b", folded)
                      .withColumns({FIRST: F.col(f"_b.{FIRST}"), LAST: F.col(f"_b.{LAST}")}))
        return merged.select(*self.key_cols, *[F.col(f"_b.v.{c}").alias(c) for c in self.value_cols],
                             F.col("_b.o").alias(self.order_col), FIRST, LAST, F.col(f"_b.{SEQ}").alias(SEQ))

    def _later(self, a: Column, b: Column) -> Column:
        """Two rows of a key in order of writing as one. ``FIRST`` is the time
        of the first write since the key last had expired, so rows can be
        merged in any grouping."""
        dead = b[FIRST] - a[LAST] >= self.ttl_us
        wins = a["o"].isNull() | F.coalesce(b["o"] >= a["o"], F.lit(False))
        best = F.when(wins, b).otherwise(a)
        joined = F.struct(best[SEQ].alias(SEQ), a[FIRST].alias(FIRST), F.greatest(a[LAST], b[LAST]).alias(LAST),
                          best["o"].alias("o"), best["v"].alias("v"))
        return F.when(dead, b).otherwise(joined)

    # -- writing -----------------------------------------------------------------
    def upsert(self, batch_df: DataFrame, batch_id: int, now: dt.datetime | None = None, writer: str = "") -> None:
        """Merge one batch of ``key_cols + value_cols + order_col`` rows."""
        m = self.manifest()
        if batch_id <= m["writers"].get(writer, -1):
            return
        now_us = _micros(now)
        best = F.max(F.struct(F.col(self.order_col).alias("o"), F.struct(*self.value_cols).alias("v")))
        seq = m["seq"] + 1
        rows = (batch_df.groupBy(*self.key_cols).agg(best.alias("_b"))
                .select(*self.key_cols, *[F.col(f"_b.v.{c}").alias(c) for c in self.value_cols],
                        F.col("_b.o").alias(self.order_col), F.lit(now_us).cast("long").alias(FIRST),
                        F.lit(now_us).cast("long").alias(LAST), F.lit(seq).cast("long").alias(SEQ)))
        if "schema" in m:       # the stored types stay
            rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromJson(m["schema"]).fields])
        else:
            m["schema"] = json.loads(T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields]).json())
        delta = self._write(rows, m, f"delta-{seq}")
        m["writers"][writer] = batch_id
        if delta["bytes"]:
            if self._gone(m, now_us):
                m["trash"] += [f["name"] for f in self.folders(m)]
                m["base"], m["deltas"] = None, []
            m["deltas"].append(delta)
            m["seq"], m["last_write"] = seq, now_us
        self._commit(m)
        if len(m["deltas"]) >= self.max_deltas:
            self.compact(now)

    def _gone(self, m: dict, at_us: int) -> bool:
        """Whether the whole store has expired."""
        return (self.ttl_us is not None and self.ttl_scope == TABLE and m["last_write"] is not None
                and at_us - m["last_write"] >= self.ttl_us)

    def compact(self, now: dt.datetime | None = None, whole: bool = False) -> None:
        """Merge the deltas into one, or with the base into a new base when
        they have grown to its ``growth`` share (or ``whole``)."""
        m = self.manifest()
        if not m["deltas"]:
            return
        grown = sum(d["bytes"] for d in m["deltas"])
        whole = whole or m["base"] is None or grown >= self.growth * m["base"]["bytes"]
        old = self.folders(m) if whole else m["deltas"]
        if len(old) < 2:
            return
        rows = self._merged(self._rows(m, old), len(old))
        if whole:       # nothing older is left that an expired key could win over
            rows = self._live(rows, _micros(now))
        new = self._write(rows, m, f"{'base' if whole else 'run'}-{m['seq']}")
        outdated = m["trash"]
        m["trash"] = [f["name"] for f in old if f["name"] != new["name"]]
        m["base"], m["deltas"] = (new if new["bytes"] else None, []) if whole else (m["base"], [new])
        self._commit(m)
        for name in set(outdated) - {f["name"] for f in self.folders(m)} - set(m["trash"]):
            textfile.delete(self.spark, self.path, name)

    def foreach_batch(self, writer: str = ""):
        """A ``writeStream.foreachBatch`` function performing ``upsert``."""
        def _fn(df: DataFrame, batch_id: int) -> None:
            self.upsert(df, batch_id, writer=writer)
        return _fn

    # -- reading -----------------------------------------------------------------
    def _live(self, rows: DataFrame, at_us: int) -> DataFrame:
        if self.ttl_us is None or self.ttl_scope == TABLE:
            return rows
        return rows.where(F.col(LAST) > at_us - self.ttl_us)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def read(self, as_of: dt.datetime | None = None) -> DataFrame:
        """The whole store without what has expired ``as_of`` (default: now)."""
        m = self.manifest()
        folders = self.folders(m)
        if not folders or self._gone(m, _micros(as_of)):
            return self._empty()
        return self._live(self._merged(self._rows(m, folders), len(folders)), _micros(as_of)).select(*self._cols)

    def scan(self, requested: DataFrame, m: dict | None = None) -> DataFrame | None:
        """The unmerged rows of the part of the store that may hold the keys of
        ``requested`` (columns ``key_cols``): the buckets they hash to, and only
        their rows where there are few. Collects bucket numbers and at most
        ``LISTED_KEYS`` keys."""
        m = m or self.manifest()
        folders = self.folders(m)
        if not folders:
            return None
        wanted = requested.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                    for f in T.StructType.fromJson(m["schema"]).fields if f.name in self.key_cols]).distinct()
        seen = wanted.groupBy(self._bucket(m).alias("b")).agg(F.count("*").alias("n")).collect()
        keys = None
        if len(self.key_cols) == 1 and sum(r["n"] for r in seen) <= LISTED_KEYS:
            keys = [r[0] for r in wanted.collect()]
        return self._rows(m, folders, sorted(r["b"] for r in seen), keys)

    def read_keys(self, requested: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
        """``read`` of at least the requested keys (others may come with them)."""
        m = self.manifest()
        rows = None if self._gone(m, _micros(as_of)) else self.scan(requested, m)
        if rows is None:
            return self._empty()
        return self._live(self._merged(rows, len(self.folders(m))), _micros(as_of)).select(*self._cols)


def _micros(t: dt.datetime | None) -> int:
    """A point in time (naive: UTC; default: now) in microseconds."""
    t = t or dt.datetime.now(dt.timezone.utc)
    t = t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)
    return round(t.timestamp() * 1_000_000)
