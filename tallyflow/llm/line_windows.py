"""Line dedup over overlapping three-line windows.

Every three consecutive lines of a text are hashed. A window that occurs more
than once anywhere keeps its first occurrence, the one with the smallest
(doc_id, text hash, line); the lines of every later occurrence are removed.
Overlapping and touching occurrences of a document are merged into runs, and
the text is put together from the lines outside the runs.

Windows are held by two 64-bit hashes. Their counts are pre-aggregated before
the shuffle, and a window that much of the corpus shares meets its occurrences
by broadcast (``join_groups``). The runs to remove are a table of their own; a
bit filter of fixed size over its documents tells which texts meet it, and all
other texts pass straight through, neither shuffled nor cut into lines. Texts of
fewer than three lines keep all lines;
a null text stays null; a text whose lines all go becomes empty. A null doc_id
counts as the smallest. Rows that repeat both doc_id and text are one document:
they are treated alike. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyflow.llm.common import join_groups, stage, wrapped

LINES = 3


def _keys() -> dict[str, Column]:
    return {"id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), "th": F.xxhash64("text")}


def windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(id, text hash, line number, hash, hash) of every window of ``docs``."""
    parts = F.split("text", "\n")

    def window(i: Column) -> Column:
        own = [F.get(F.col("parts"), i + k) for k in range(lines)]
        return F.struct(i.alias("line"), F.xxhash64(*own).alias("h1"),
                        F.xxhash64(F.lit("second"), *reversed(own)).alias("h2"))

    return (docs.select(*[c.alias(k) for k, c in _keys().items()], parts.alias("parts"))
            .where(F.size("parts") >= lines)
            .select("id", "th", F.explode(F.transform(F.sequence(F.lit(0), F.size("parts") - lines), window)).alias("w"))
            .select("id", "th", "w.line", "w.h1", "w.h2"))


def covered(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """Per document the runs of lines to remove: id, th, runs (first, last)."""
    rows = stage(windows(docs, lines), "line-windows")
    place = F.struct("id", "th", "line")
    groups = stage(rows.groupBy("h1", "h2").agg(F.min(place).alias("one"), F.count("*").alias("n"))
                   .where("n > 1"), "line-groups")
    later = (join_groups(rows, groups, ["h1", "h2"], "n").where(place > F.col("one"))
             .select("id", "th", "line").distinct())
    w = Window.partitionBy("id", "th").orderBy("line")
    fresh = F.coalesce(F.col("line") > F.lag("line").over(w) + lines, F.lit(True))
    runs = (later.withColumn("fresh", fresh.cast("int")).withColumn("run", F.sum("fresh").over(w))
            .groupBy("id", "th", "run")
            .agg(F.min("line").alias("first"), (F.max("line") + lines - 1).alias("last")))
    return runs.groupBy("id", "th").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))


# Bits of the filter of touched documents: at most BITS / 64 rows of one long.
BITS = 1 << 24


def _place() -> Column:
    return F.pmod(F.xxhash64("id", "th"), F.lit(BITS))


def touched(rows: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (id, th) in two: those that may have ``runs`` and those that
    have none, told apart where they are."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(_place(), F.lit(64)).cast("int"))
    words = runs.groupBy(F.floor(_place() / 64).alias("at")).agg(F.bit_or(bit).alias("bits"))
    marked = rows.withColumn("at", F.floor(_place() / 64)).join(F.broadcast(words), "at", "left")
    hit = F.coalesce(F.getbit("bits", F.pmod(_place(), F.lit(64)).cast("int")) == 1, F.lit(False))
    return marked.where(hit).drop("at", "bits"), marked.where(~hit).drop("at", "bits")


def dedup(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text`` and the columns
    ``n_lines`` (before) and ``n_removed`` (in place of columns of that name)."""
    runs = stage(covered(docs, lines), "line-runs")
    some, none = touched(wrapped(docs, **_keys()), runs)

    def result(df: DataFrame, text: Column, n_lines: Column, n_removed: Column) -> DataFrame:
        same = [F.col(f"_row.`{c}`") if c != "text" else text.alias("text")
                for c in docs.columns if c not in ("n_lines", "n_removed")]
        return df.select(*same, n_lines.cast("int").alias("n_lines"), n_removed.cast("int").alias("n_removed"))

    old = F.col("_row.text")
    ends = F.octet_length(old) - F.octet_length(F.replace(old, F.lit("\n"), F.lit("")))
    whole = result(none, old, F.coalesce(ends + 1, F.lit(0)), F.lit(0))

    some = some.join(runs, ["id", "th"], "left").withColumn("parts", F.split(old, "\n"))
    n = F.coalesce(F.size("parts"), F.lit(0))
    r = F.col("runs")
    # between one run's end and the next run's start
    starts = F.concat(F.array(F.lit(0)), F.transform(r, lambda x: x["last"] + 1))
    stops = F.concat(F.transform(r, lambda x: x["first"]), F.array(n))
    kept = F.flatten(F.zip_with(starts, stops, lambda a, b: F.slice(F.col("parts"), a + 1, b - a)))
    removed = F.aggregate(r, F.lit(0), lambda s, x: s + x["last"] - x["first"] + 1)
    cut = result(some, F.when(r.isNull(), old).otherwise(F.array_join(kept, "\n")),
                 F.when(old.isNull(), F.lit(0)).otherwise(n), F.coalesce(removed, F.lit(0)))
    return whole.unionByName(cut)


ORACLE = f"""
WITH parts AS (SELECT doc_id, text, string_split(text, chr(10)) AS p FROM documents),
w AS (SELECT doc_id, i - 1 AS line, list_slice(p, i, i + {LINES - 1}) AS win
      FROM parts, unnest(range(1, len(p) - {LINES - 2})) AS r(i)),
later AS (SELECT doc_id, line FROM w
          QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, line) > 1),
cov AS (SELECT DISTINCT doc_id, line + k AS line FROM later, unnest(range({LINES})) AS r(k)),
gone AS (SELECT doc_id, count(*) AS n, list(line) AS cut FROM cov GROUP BY doc_id)
SELECT doc_id, len(p)::INTEGER AS n_lines, coalesce(n, 0)::INTEGER AS n_removed,
       CASE WHEN n IS NULL THEN text ELSE array_to_string(
           list_filter(p, lambda x, i: NOT list_contains(cut, i - 1)), chr(10)) END AS text
FROM parts LEFT JOIN gone USING (doc_id)
"""
