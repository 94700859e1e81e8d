"""Mixing sources to target weights by subset-sum budget fitting.

A document's size is its number of words (null: 0). Sources in code point
order, null last, weigh 1, 2, 3, 1, 2, 3, ... and share a budget of all sizes;
a target stops at ``most`` times its source's size and the excess is shared
again by weight until none is above.

A source takes as many whole passes over its documents as fit its target. The
rest of the target is a subset-sum problem over the documents' exact sizes,
solved on the counts per size (``fit``): an even share of every size, then
longest sizes first, then bounded-knapsack dynamic programming over the words
still missing. Which documents of a size are taken follows a seeded hash of
doc_id and text, so reruns agree.

Null and empty texts have size 0 and are never short of their target. Rows
that repeat doc_id and text hash alike and are taken together. An empty table
gives no rows. Columns other than doc_id, source and text are kept by ``mix``
and play no part.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyflow.llm.common import join_groups, partitions, stage, word_count, wrapped

MOST = 3
DP_WORDS = 1 << 16
BUCKET_ROWS = 500
BROADCAST_ROWS = 200_000


# -- the fit on counts per size ----------------------------------------------

def fit(sizes: list[int], counts: list[int], budget: int, dp_words: int = DP_WORDS) -> list[int]:
    """How many documents of each size to take so that their words come to
    ``budget`` or as near to it as the programme finds: the nearest sum below,
    or one more document where that ends nearer above.

    The dynamic programme covers ``dp_words`` words at least, whatever the
    budget, so its memory is bounded; the words before that are taken evenly
    over the sizes, then from the longest.
    """
    total = sum(s * c for s, c in zip(sizes, counts))
    if budget >= total:
        return list(counts)
    take = _below(sizes, counts, budget, total, dp_words)
    short = budget - sum(s * n for s, n in zip(sizes, take))
    spare = [s for s, c, n in zip(sizes, counts, take) if s and n < c]
    if spare and abs(min(spare) - short) < short:
        take[sizes.index(min(spare))] += 1
    return take


def _below(sizes: list[int], counts: list[int], budget: int, total: int, dp_words: int) -> list[int]:
    take = [c * budget // total if s else 0 for s, c in zip(sizes, counts)]
    left = budget - sum(s * n for s, n in zip(sizes, take))
    order = sorted((i for i, s in enumerate(sizes) if s > 0), key=lambda i: -sizes[i])
    for i in order:
        if left > dp_words:
            n = min(counts[i] - take[i], (left - dp_words) // sizes[i])
            take[i], left = take[i] + n, left - n * sizes[i]
    if left > 2 * dp_words:        # only sizes over left - dp_words remain: one document fits
        for i in order:
            if sizes[i] <= left and take[i] < counts[i]:
                take[i] += 1
                return take
        return take
    # bit b of ``sums``: b words can be made of the documents seen so far
    sums, full, steps = 1, (1 << (left + 1)) - 1, []
    for i in order:
        n, k = min(counts[i] - take[i], left // sizes[i]), 1
        while n > 0 and not sums >> left & 1:
            k = min(k, n)
            steps.append((i, k, sums))
            sums |= sums << (k * sizes[i]) & full
            n, k = n - k, k * 2
    at = sums.bit_length() - 1
    for i, k, before in reversed(steps):
        if not before >> at & 1:
            take[i], at = take[i] + k, at - k * sizes[i]
    return take


def _fit_source(hist: pd.DataFrame) -> pd.DataFrame:
    hist = hist.sort_values("size").reset_index(drop=True)
    own, target = int(hist["source_size"].iloc[0]), float(hist["target"].iloc[0])
    passes = min(int(target // own), MOST) if own else 0
    budget = min(max(round(target - passes * own), 0), own) if passes < MOST else 0
    hist["passes"] = passes
    hist["take"] = fit([int(s) for s in hist["size"]], [int(c) for c in hist["n"]], budget)
    return hist[["skey", "size", "n", "source_size", "target", "passes", "take"]]


# -- targets ------------------------------------------------------------------

def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` (skey, source_size) with ``target``.

    Sources are numbered over sorted range partitions (no single task holds
    them all); the reshare keeps one number, the words per unit of weight.
    """
    n = partitions(sources.sparkSession)
    ranked = stage(sources.repartitionByRange(n, "skey").sortWithinPartitions("skey")
                   .withColumn("at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("at", 33)
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (ranked.groupBy(part.alias("part")).agg(F.count("*").alias("c"))
              .select("part", F.coalesce(F.sum("c").over(w), F.lit(0)).alias("before")))
    place = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
    ranked = (ranked.withColumn("part", part).join(F.broadcast(before), "part")
              .withColumn("weight", (place % 3 + 1).cast("double")).drop("part", "at", "before"))
    cap = F.col("source_size") * most
    total, weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    unit, capped = (total / weights if weights else 0.0), -1
    while True:
        over = cap < F.col("weight") * unit
        k, words, free = ranked.agg(
            F.coalesce(F.sum(over.cast("long")), F.lit(0)),
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
            F.sum(F.when(~over, F.col("weight")))).first()
        if k == capped or not free:
            break
        unit, capped = (total - words) / free, k
    return ranked.withColumn("target", F.least(cap.cast("double"), F.col("weight") * unit)).drop("weight")


# -- over the documents -------------------------------------------------------

def _keys(seed: int) -> dict[str, Column]:
    """Source key (null last), size and seeded order of a document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key: Column = F.when(F.col("source").isNull(), F.lit("1")).otherwise(
        F.concat(F.lit("0"), F.col("source")))
    return {"_mix_skey": key, "_mix_size": word_count(F.col("text")),
            "_mix_order": F.xxhash64(F.lit(seed), "doc_id", text)}


def plan(keyed: DataFrame, most: int = MOST) -> DataFrame:
    """Per source key and size: n, source_size, target, passes, and ``cut``:
    a document is taken once more when its order is at most the cut."""
    rows = keyed.select(F.col("_mix_skey").alias("skey"), F.col("_mix_size").alias("size"),
                        F.col("_mix_order").alias("o"), F.col("_mix_tie").alias("t"))
    hist = stage(rows.groupBy("skey", "size").agg(F.count("*").alias("n")), "size-counts")
    sources = targets(hist.groupBy("skey").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), most)
    fitted = stage(hist.join(sources, "skey").groupBy("skey").applyInPandas(
        _fit_source, "skey string, size long, n long, source_size long, target double, "
                     "passes int, take long"), "size-takes")
    # The take-th smallest order of each (source, size): a group of n is first
    # cut by leading bits of the order into buckets of about sqrt(n) rows,
    # BUCKET_ROWS at least, so neither a bucket nor the list of a group's
    # buckets is large.
    some = fitted.where("take > 0 and take < n").select(
        "skey", "size", "n", "take",
        F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / F.greatest(F.lit(BUCKET_ROWS), F.sqrt("n"))))).cast("int")
        .alias("bits"))
    bucket = F.expr("if(bits = 0, 0L, shiftright(o, 64 - bits))").alias("bucket")
    member = join_groups(rows, some, ["skey", "size"], "n").select("skey", "size", "take", "o", "t", bucket)
    key = ["skey", "size"]
    counts = member.groupBy(*key, "bucket", "take").agg(F.count("*").alias("c"))
    w = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = (counts.withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0)))
            .where("before < take and before + c >= take")
            .select(*key, "bucket", F.col("c").alias("rows"), (F.col("take") - F.col("before")).alias("rank")))
    inside = join_groups(member.select(*key, "bucket", "o", "t"), stage(edge, "size-edges"),
                         [*key, "bucket"], "rows")
    nth = F.row_number().over(Window.partitionBy(*key, "bucket").orderBy("o", "t"))
    cuts = inside.withColumn("nth", nth).where("nth = rank").select(*key, F.struct("o", "t").alias("cut"))
    last = F.lit((1 << 63) - 1)
    every = F.when(F.col("take") >= F.col("n"), F.struct(last.alias("o"), last.alias("t")))
    return stage(fitted.join(cuts, key, "left").select(
        *key, "n", "source_size", "target", "passes",
        F.when(F.col("take") > 0, F.coalesce("cut", every)).alias("cut")), "mix-plan")


def _decide(keyed: DataFrame, most: int) -> DataFrame:
    p = plan(keyed, most).select(
        F.col("skey").alias("_mix_skey"), F.col("size").alias("_mix_size"), F.col("n").alias("_mix_n"),
        F.col("source_size").alias("_mix_source_size"), F.col("target").alias("_mix_target"),
        F.col("passes").alias("_mix_passes"), F.col("cut").alias("_mix_cut"))
    keys = ["_mix_skey", "_mix_size"]
    if p.count() <= BROADCAST_ROWS:
        out = keyed.join(F.broadcast(p), keys)
    else:
        out = join_groups(keyed, p, keys, "_mix_n")
    at = F.struct(F.col("_mix_order").alias("o"), F.col("_mix_tie").alias("t"))
    more = F.coalesce((at <= F.col("_mix_cut")).cast("int"), F.lit(0))
    return out.withColumn("_mix_copies", F.col("_mix_passes") + more)


def _staged(keyed: DataFrame) -> DataFrame:
    """Sizes and orders made once, each row with a number of its own: of rows
    that repeat both doc_id and text the cut can take any part, and which of
    them makes no difference."""
    return stage(keyed.withColumn("_mix_tie", F.monotonically_increasing_id()), "mix-rows")


def decisions(docs: DataFrame, seed: int = 10, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    return _decide(_staged(docs.select("doc_id", *[c.alias(k) for k, c in _keys(seed).items()])), most).select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("_mix_size") * F.col("_mix_copies")).alias("taken"))


def mix(docs: DataFrame, seed: int = 10, most: int = MOST) -> DataFrame:
    """The mixed documents with the columns of ``docs``: a document taken k
    times comes k times; sizes of 0 go with their source's whole passes, and
    stay where the source has none."""
    out = _decide(_staged(wrapped(docs, **_keys(seed))), most)
    copies = F.when(F.col("_mix_size") == 0, F.greatest(F.col("_mix_passes"), F.lit(1))).otherwise(
        F.col("_mix_copies"))
    return (out.withColumn("_mix_copies", copies).where("_mix_copies > 0")
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select("_row.*"))
