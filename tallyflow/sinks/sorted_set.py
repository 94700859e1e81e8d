"""K6: a ranking kept as a sorted set that batches update.

Members lie in *ranges* of score, each a folder of its own, about
``range_rows`` members each. The file ``_ranges`` holds every range's lower bound
and count, a few bytes per million members, and is replaced in one step.

* ``update`` looks up the old scores of a batch's members (in a
  ``KeyedStore``, which opens only their buckets), rewrites the ranges that they
  leave or enter, and splits those that have grown to twice the size. All other
  ranges stay as they are.
* ``page`` adds up counts from the top and opens only the ranges that hold the
  ranks asked for; ``ranks`` opens only the ranges of the members asked for.

Equal scores share a rank, one more than the number of greater scores, so they
are always in one range; a range of a single score is not split and may be of
any size. Null scores come last and are a range of their own. Of a batch's rows
for a member the greatest score counts; a later batch replaces the score. Batch
ids ascend; one not above the last is a replay and changes nothing. Null members
are members. Members never leave.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyflow.sinks import textfile
from tallyflow.sinks.keyed_store import KeyedStore

RANGES = "_ranges"
LOWEST, NULLS = "lowest", "null"        # the bounds of the first range and of the null scores
FILE_ROWS = 100_000                     # about the rows of a file


class SortedSet:
    """(member, score) by descending score on a shared file system."""

    def __init__(self, spark: SparkSession, path: str, member: str = "key", score: str = "score",
                 range_rows: int = 1_000_000, schema: str | None = None, **layout):
        """``schema``: the two columns an empty set reads as (default: a text
        and a long). ``layout``: settings of the store of scores."""
        if range_rows < 1:
            raise ValueError("range_rows must be at least 1")
        self.spark, self.path, self.member, self.score, self.range_rows = spark, path.rstrip("/"), member, score, range_rows
        self.schema = schema or f"{member} string, {score} long"
        self.scores = KeyedStore(spark, f"{self.path}/scores", (member,), (score,), "_batch",
                                 schema=f"{self.schema}, _batch long", **layout)

    # -- ranges ---------------------------------------------------------------
    def ranges(self) -> dict:
        """``batch``, ``seq`` and the list ``ranges`` of (lo, count, folder),
        ascending, those of null scores first."""
        text = textfile.read_text(self.spark, self.path, RANGES)
        return json.loads(text) if text else {"batch": -1, "seq": 0, "ranges": [], "trash": []}

    def _place(self, bounds: list) -> Column:
        """The number of a score's range among the bounds (``NULLS``,
        ``LOWEST``, then numbers, ascending), by binary search."""
        lows = bounds[2:]
        if not lows:
            return F.when(F.col(self.score).isNull(), F.lit(0)).otherwise(1)
        steps, jumps = F.array(*[F.lit(b) for b in lows]), [1 << k for k in reversed(range(len(lows).bit_length()))]
        above = F.aggregate(F.array(*[F.lit(j) for j in jumps]), F.lit(0), lambda at, jump: F.when(
            F.get(steps, at + jump - 1) <= F.col(self.score), at + jump).otherwise(at))     # past the last one: null
        return F.when(F.col(self.score).isNull(), F.lit(0)).otherwise(above + 1)

    def _read(self, ranges: list[dict]) -> DataFrame:
        """The members of some ranges."""
        schema = self.spark.createDataFrame([], self.schema).schema
        paths = [f"{self.path}/{r['folder']}" for r in ranges if r["count"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # -- update -----------------------------------------------------------------
    def update(self, batch: DataFrame, batch_id: int) -> None:
        m = self.ranges()
        rows = batch.groupBy(self.member).agg(F.max(self.score).alias(self.score)).select(self.member, self.score)
        types = {f.name: f.dataType for f in self.spark.createDataFrame([], self.schema).schema.fields}
        rows = rows.select(*[F.col(c).cast(types[c]).alias(c) for c in (self.member, self.score)])
        # several jobs read the rows: a batch, maybe a stream's with its state, is evaluated once
        stage = f"batch-{batch_id}"
        rows.write.mode("overwrite").parquet(f"{self.path}/{stage}")
        rows = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{stage}")
        if batch_id > m["batch"]:
            self._rewrite(m, rows, batch_id)
        # after the ranges: a batch that fails between the two is replayed and
        # comes here again, where the store knows whether it has it
        self.scores.upsert(rows.withColumn("_batch", F.lit(batch_id).cast("long")), batch_id)
        textfile.delete(self.spark, self.path, stage)

    def _sizes(self, members: DataFrame, place: Column) -> dict:
        """By range: count, least and greatest score."""
        values = members.groupBy(self.score).agg(F.count("*").alias("_c"))
        found = values.groupBy(place.alias("p")).agg(F.sum("_c").alias("n"), F.min(self.score).alias("low"), F.max(self.score).alias("high"))
        return {r["p"]: r for r in found.collect()}

    def _rewrite(self, m: dict, rows: DataFrame, batch_id: int) -> None:
        ranges = m["ranges"] or [{"lo": b, "count": 0, "folder": None} for b in (NULLS, LOWEST)]
        place = self._place([r["lo"] for r in ranges])
        old = self.scores.read_keys(rows.select(self.member))
        old = old.join(rows, old[self.member].eqNullSafe(rows[self.member]), "left_semi").select(self.member, self.score)
        scores = old.unionByName(rows).select(self.score).distinct()
        touched = sorted(r[0] for r in scores.select(place.alias("p")).distinct().collect())
        kept = self._read([ranges[p] for p in touched]).alias("k")
        kept = kept.join(rows.alias("r"), F.col(f"k.{self.member}").eqNullSafe(F.col(f"r.{self.member}")), "left_anti")
        seq = m["seq"] + 1
        stage = f"{self.path}/update-{seq}"
        kept.unionByName(rows).write.mode("overwrite").parquet(stage)
        members = self.spark.read.schema(rows.schema).parquet(stage)
        bounds, folder = self._bounds(ranges, members, place, self._sizes(members, place)), f"ranges-{seq}"
        finer = self._place(bounds)
        counts = {p: r["n"] for p, r in self._sizes(members, finer).items()}
        # a range of one score may be of any size: about FILE_ROWS rows of a range to a task
        pieces = F.array(*[F.lit(-(-counts.get(p, 0) // FILE_ROWS) or 1) for p in range(len(bounds))])
        piece = F.pmod(F.xxhash64(self.member), F.get(pieces, F.col("_range")))
        (members.withColumn("_range", finer).repartition(F.col("_range"), piece).sortWithinPartitions("_range", F.desc(self.score))
         .write.mode("overwrite").partitionBy("_range").parquet(f"{self.path}/{folder}"))
        at = {r["lo"]: (p, r) for p, r in enumerate(ranges)}
        new, parent = [], 0
        for p, lo in enumerate(bounds):
            parent = at[lo][0] if lo in at else parent
            new.append({"lo": lo, "count": counts.get(p, 0), "folder": f"{folder}/_range={p}"} if parent in touched else at[lo][1])
        kept_folders = {r["folder"] for r in new}
        outdated, trash = m["trash"], [r["folder"] for r in ranges if r["folder"] and r["folder"] not in kept_folders]
        textfile.replace_text(self.spark, self.path, RANGES, json.dumps(
            {"batch": batch_id, "seq": seq, "ranges": new, "trash": [*trash, f"update-{seq}"]}))
        for name in outdated:       # replaced by the update before this one: its readers have finished
            textfile.delete(self.spark, self.path, name)

    def _bounds(self, ranges: list[dict], members: DataFrame, place: Column, sizes: dict) -> list:
        """The ranges' bounds, with more of them where a range of several scores
        is twice too large: one job for all of these. Where exactly is a matter
        of size only."""
        bounds, parts = [r["lo"] for r in ranges], {}
        for p, r in sizes.items():
            if p > 0 and r["n"] >= 2 * self.range_rows and r["low"] < r["high"]:
                parts.setdefault(r["n"] // self.range_rows, []).append(p)
        if not parts:
            return bounds
        large = members.withColumn("_p", place).where(F.col("_p").isin([p for ps in parts.values() for p in ps]))
        cuts = large.groupBy("_p").agg(*[
            F.percentile_approx(F.when(F.col("_p").isin(ps), F.col(self.score)), [k / n for k in range(1, n)]).alias(f"c{n}")
            for n, ps in parts.items()]).collect()
        found = {c for r in cuts for got in r[1:] for c in got or [] if c > sizes[r["_p"]]["low"]}
        return [*bounds[:2], *sorted({*bounds[2:], *found})]

    # -- queries ------------------------------------------------------------------
    def _ranked(self, ranges: list[dict], chosen: list[int], asked: DataFrame | None = None) -> DataFrame:
        """The members of some ranges (of ``asked``: column ``member``) with their
        rank in the whole set, by one plan for any number of ranges. Only the
        distinct scores of a range are put in order, and they are at most
        twice ``range_rows``, or one."""
        above, total = [0] * len(ranges), 0
        for p in reversed(range(len(ranges))):
            above[p] = total
            total += ranges[p]["count"]
        rows = self._read([ranges[p] for p in chosen])
        if not chosen:
            return rows.withColumn("rank", F.lit(None).cast("long"))
        values = rows.groupBy(F.col(self.score)).agg(F.count("*").alias("_c"))
        values = values.withColumn("_p", self._place([r["lo"] for r in ranges]))
        before = Window.partitionBy("_p").orderBy(F.desc(self.score)).rowsBetween(Window.unboundedPreceding, -1)
        start = F.get(F.array(*[F.lit(n).cast("long") for n in above]), F.col("_p"))
        values = values.select(F.col(self.score).alias("_v"), (F.coalesce(F.sum("_c").over(before), F.lit(0)) + 1 + start).cast("long").alias("rank"))
        if asked is not None:
            asked = asked.select(F.col(self.member).alias("_m"))
            rows = rows.join(asked, F.col(self.member).eqNullSafe(F.col("_m")), "left_semi")
        return rows.join(values, rows[self.score].eqNullSafe(values["_v"])).select(self.member, self.score, "rank")

    def chosen(self, first: int, last: int) -> list[int]:
        """The ranges that hold the ranks ``first`` to ``last``, highest first."""
        out, above = [], 0
        ranges = self.ranges()["ranges"]
        for p in reversed(range(len(ranges))):
            n = ranges[p]["count"]
            if n and above + 1 <= last and above + n >= first:
                out.append(p)
            above += n
        return out

    def page(self, first: int, last: int) -> DataFrame:
        """The members of the ranks ``first`` to ``last`` (both included), with
        their rank."""
        return (self._ranked(self.ranges()["ranges"], self.chosen(first, last))
                .where((F.col("rank") >= first) & (F.col("rank") <= last)))

    def ranks(self, members: DataFrame) -> DataFrame:
        """Member, score and rank of those of ``members`` (column ``member``)
        that the set has."""
        ranges = self.ranges()["ranges"]
        found = self.scores.read_keys(members.select(self.member))
        found = found.join(members.select(F.col(self.member).alias("_m")).distinct(), F.col(self.member).eqNullSafe(F.col("_m")), "left_semi")
        if not ranges:
            return self._ranked([], [])
        place = self._place([r["lo"] for r in ranges]).alias("p")
        chosen = [r[0] for r in found.select(self.score).distinct().select(place).distinct().collect()]
        return self._ranked(ranges, sorted(chosen, reverse=True), found)
