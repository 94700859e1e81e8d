"""Top-N and ranking (IDs O1, O2, K6).

``top_n_per_group`` filters a row number by ``<= n``. Spark turns that filter
into a WindowGroupLimit up to ``spark.sql.optimizer.windowGroupLimitThreshold``
(1000): each map task then keeps its own top ``n`` per group before the
exchange.

``rank_top`` ranks a whole table. Equal values share a rank, so any number of
rows may tie; it ranks the distinct values, never the rows, and joins the ranks
back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(counts: DataFrame, n: int,
                    group_cols: tuple[str, ...] = ("window_start", "window_end"),
                    order_col: str = "n", key_col: str = "key",
                    rank_col: str = "rank") -> DataFrame:
    """O1: the ``n`` largest rows per group, ties broken by ``key_col``
    ascending (a stable, total order)."""
    w = Window.partitionBy(*group_cols).orderBy(F.desc(order_col), F.asc(key_col))
    return (counts.withColumn(rank_col, F.row_number().over(w).cast("long"))
            .where(F.col(rank_col) <= n))


def rank_top(df: DataFrame, n: int, order_col: str = "n", key_col: str = "key",
             rank_col: str = "rank") -> DataFrame:
    """O2 / K6: rank rows by ``order_col`` descending (equal values share a
    rank, as in a sorted set listing) and keep ranks ``<= n``. Null values
    come last and share a rank.

    A rank is 1 + the number of rows with a greater value. Ranks up to ``n``
    belong to the ``n`` greatest distinct values at most: those are counted
    (a partial and final aggregate, then a top-``n`` of values), summed up in
    order, and their ``n`` rows at most are broadcast to the rows.
    """
    counts = df.groupBy(F.col(order_col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    top = counts.orderBy(F.desc_nulls_last("_v")).limit(n)
    before = Window.orderBy(F.desc_nulls_last("_v")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (top.withColumn(rank_col, F.coalesce(F.sum("_c").over(before), F.lit(0)) + 1)
             .where(F.col(rank_col) <= n).drop("_c"))
    return df.join(F.broadcast(ranks), df[order_col].eqNullSafe(ranks["_v"])).select(*df.columns, rank_col)


def store_ranking(ranked: DataFrame, path: str, order_col: str = "n", key_col: str = "key",
                  rank_col: str = "rank") -> None:
    """K6: write a ranking as the current listing (rank, key, value), replacing
    the one before."""
    (ranked.select(rank_col, key_col, order_col).coalesce(1).sortWithinPartitions(rank_col, key_col)
     .write.mode("overwrite").parquet(path))
