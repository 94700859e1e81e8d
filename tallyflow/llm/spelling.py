"""Spelling variants: words one edit apart, grouped under the commoner form.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. A word's form is its near word of largest count (ties: smallest in
code-point order) if that is at least ``RATIO`` times the word's count, and its
root the last word when forms are followed.

Nearness is found by dense tiling. Words stand in blocks as padded matrices of
code points, and two blocks are compared whole: the length of the common prefix
of every pair, column by column from the left, and of the common suffix from
the right. A pair is near if prefix and suffix together reach the longer length
less one (they cannot count a letter of the shorter word twice: their sum is cut
at its length).

Which blocks meet: let b be the longer length. A near pair shares its first
``a`` and its last ``b - 1 - a`` code points, where ``a`` is its common prefix
(cut at b - 1). A *node* (b, lo, hi) takes the pairs with lo <= a <= hi; they all
share their first lo and last b - 1 - hi code points, and words are grouped by
those. Each word stands in the nodes of its own length and of one more, and each
pair belongs to one node, so it is counted once. A group of more than ``TILE``
words is split in two nodes, lo..mid-1 and mid..hi, which share more code points,
until it is small enough or lo = hi; then its words differ in one place only,
and there are no more of them than letters. So no group is all pairs of a hot
prefix, and none is cut short.

``vocabulary`` makes the words of the registered query: maximal runs of
``[A-Za-z\\u00C0-\\u00FF]`` in whole texts, A-Z lower-cased, one code point of
every 31st run deleted by a checksum of doc_id and run.

Defined results: null texts have no runs; a null doc_id counts as empty in the
checksum; repeated rows count again; runs may be of any length (blocks get
lower as words get longer); other columns play no part; an empty table has no
words. ``group`` takes words once each, with their counts; null words are left
out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import ascii_lower, crc32_sql, join_groups, partitions, stage

RUN = r"[A-Za-zÀ-ÿ]"
SHORTEST = 7
LEAST = 2
LOSE = 31
RATIO = 10

TILE = 512          # words of a group that are compared without a further split
CELLS = 1 << 18     # code points of a block pair's widest comparison, at most

GROUP = ["b", "lo", "hi", "g"]


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, lose: int = LOSE) -> DataFrame:
    """(word, n): the words of at least ``shortest`` code points that occur at
    least ``least`` times. Shorter runs cannot give one and are not cut out."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col("text"), F.lit(f"{RUN}{{{shortest},}}"), F.lit(0))).alias("run"))
    runs = runs.select("id", ascii_lower(F.col("run")).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    lost = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % lose == 0, lost).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least))


def _grouped(nodes: DataFrame) -> DataFrame:
    """Nodes (b, lo, hi, word, n) with ``g``, a hash of the code points that
    the node's pairs share. A clash of hashes only brings words together that
    the comparison keeps apart."""
    b, lo, hi = F.col("b"), F.col("lo"), F.col("hi")
    return nodes.withColumn("g", F.xxhash64(F.left("word", lo), F.right("word", b - 1 - hi)))


def _halves(nodes: DataFrame, mid: Column) -> DataFrame:
    """Each node as its two halves, lo..mid-1 and mid..hi."""
    parts = F.array(F.struct(F.col("lo").alias("lo"), (mid - 1).alias("hi")), F.struct(mid.alias("lo"), F.col("hi").alias("hi")))
    return nodes.withColumn("part", F.explode(parts)).select("b", "part.lo", "part.hi", "word", "n")


def _without(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of no group in ``groups``. As in ``join_groups`` the largest
    groups (fewer than a thousand) are sorted out where the rows are."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    most = groups.where(F.col("size") > total / 1000).select(*GROUP)
    return rows.join(F.broadcast(most), GROUP, "left_anti").join(groups.select(*GROUP), GROUP, "left_anti")


def groups(words: DataFrame) -> DataFrame:
    """Rows b, lo, hi, g, word, n: the words by the node groups to compare."""
    n = F.length("word")
    both = words.select("word", "n", F.explode(F.array(n, n + 1)).alias("b")).select(
        "b", F.lit(0).alias("lo"), (F.col("b") - 1).alias("hi"), "word", "n")
    rows, out = _grouped(_halves(both, F.floor(F.col("b") / 2).cast("int"))), None
    while True:
        sizes = rows.where("lo < hi").groupBy(*GROUP).agg(F.count("*").alias("size"))
        large = stage(sizes.where(F.col("size") > TILE), "spelling-large")
        if large.isEmpty():
            return rows if out is None else out.unionByName(rows)
        small = _without(rows, large)
        out = small if out is None else out.unionByName(small)
        split = join_groups(rows, large, GROUP, "size").drop("size", "g")
        mid = F.floor((F.col("lo") + F.col("hi") + 1) / 2).cast("int")
        rows = stage(_grouped(_halves(split, mid)), "spelling-split")


def _codes(words: list[str], width: int, right: bool) -> np.ndarray:
    """One row of code points per word, padded on the other side."""
    text = "".join(w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words)
    try:
        flat = np.frombuffer(text.encode("latin-1"), np.uint8)
    except UnicodeEncodeError:
        flat = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat.reshape(len(words), width)


def _common(x: np.ndarray, y: np.ndarray, columns: Iterator[int]) -> np.ndarray:
    """How many of ``columns``, in order, each row of x and of y share."""
    alive = np.ones((len(x), len(y)), dtype=bool)
    n = np.zeros(alive.shape, dtype=np.int32)
    for k in columns:
        alive &= x[:, k, None] == y[None, :, k]
        if not alive.any():
            break
        n += alive
    return n


def near(words: list[str], group: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray,
         cells: int = CELLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of near words within groups: rows are sorted by group, and
    every block meets itself and the following blocks that its last group
    reaches."""
    size = np.array([len(w) for w in words])
    start = 0
    while start < len(words):
        # as many rows as are compared within the cells, by the widest of them
        step = max(1, min(128, int((cells / max(1, size[start])) ** 0.5)))
        stop = start + step
        while stop - start > 1 and (stop - start) ** 2 * int(size[start:stop].max()) > 2 * cells:
            stop -= max(1, (stop - start) // 2)
        stop = min(stop, len(words))
        reach = np.searchsorted(group, group[stop - 1], side="right")
        for at in range(start, reach, step):
            end = min(at + step, reach)
            mine, other = slice(start, stop), slice(at, end)
            both = words[mine] + words[other]
            width, k = int(max(size[mine].max(), size[other].max())), stop - start
            left, tail = _codes(both, width, False), _codes(both, width, True)
            shorter = np.minimum(size[mine, None], size[None, other])
            longer = np.maximum(size[mine, None], size[None, other])
            prefix = np.minimum(_common(left[:k], left[k:], range(width)), shorter)
            suffix = np.minimum(_common(tail[:k], tail[k:], range(width - 1, -1, -1)), shorter)
            a = np.minimum(prefix, longer - 1)
            hit = ((np.minimum(prefix + suffix, shorter) >= longer - 1) & (group[mine, None] == group[None, other])
                   & (longer == b[mine, None]) & (a >= lo[mine, None]) & (a <= hi[mine, None]))
            if at < stop:       # the block itself: each pair once, no row with itself
                hit &= np.arange(start, stop)[:, None] < np.arange(at, end)[None, :]
            i, j = np.nonzero(hit)
            if len(i):
                yield i + start, j + at
        start = stop


NEAR = "word string, n_near long, form string, form_n long"


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word and batch of whole groups: its near words there, and the best."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if not len(rows):
            continue
        cols = [rows.column(c).to_numpy() for c in GROUP]
        new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        last = int(new[-1]) if len(new) else 0
        yield from _best(rows.slice(0, last))
        held = rows.slice(last)
    if held is not None:
        yield from _best(held)


def _best(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    if len(rows) < 2:
        return
    cols = [rows.column(c).to_numpy() for c in GROUP]
    group = np.append(0, np.cumsum(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])))
    many = np.bincount(group)[group] > 1
    keep = np.flatnonzero(many)
    if not len(keep):
        return
    words, n = rows.column("word").take(keep).to_pylist(), rows.column("n").to_numpy()[keep]
    order = sorted(range(len(words)), key=lambda k: (-n[k], words[k]))
    rank = np.empty(len(words), dtype=np.int64)
    rank[order] = np.arange(len(words))
    count, best = np.zeros(len(words), dtype=np.int64), np.full(len(words), len(words))
    for i, j in near(words, group[keep], *(c[keep] for c in cols[:3])):
        np.add.at(count, i, 1)
        np.add.at(count, j, 1)
        np.minimum.at(best, i, rank[j])
        np.minimum.at(best, j, rank[i])
    found = np.flatnonzero(count).tolist()
    if found:
        forms = [order[best[k]] for k in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([words[k] for k in found]), pa.array(count[found]), pa.array([words[k] for k in forms]),
             pa.array(n[forms])], ["word", "n_near", "form", "form_n"])


def links(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of every word with near words."""
    rows = groups(words)
    parts = (rows.repartition(partitions(words.sparkSession), *GROUP).sortWithinPartitions(*GROUP)
             .mapInArrow(_tiles, NEAR))
    best = F.min(F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("form")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select(
        "word", "n_near", F.col("top.form").alias("best"), (-F.col("top.m")).alias("best_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, root) followed to the last, each round over
    twice the way. Counts grow with every step, so there are no circles."""
    roots = forms
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(on, "root", "left_semi").isEmpty():
            return roots
        roots = stage(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def group(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``words`` (word, n)."""
    words = stage(words.where("word is not null").select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    rows = words.join(links(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *[F.when(F.col("best_n") >= ratio * F.col("n"), F.col(c)).alias(k) for c, k in (("best", "form"), ("best_n", "form_n"))])
    rows = stage(rows, "spelling-forms")
    roots = _roots(stage(rows.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = f"""
WITH RECURSIVE runs AS (
  SELECT id, {_LOWER.format("run")} AS run FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
           unnest(regexp_extract_all(coalesce(text, ''), '{RUN}{{{SHORTEST},}}')) AS run FROM documents)),
sums AS (SELECT run, {crc32_sql("(id || ':' || run)")} AS h FROM runs),
words AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % {LOSE} = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2)
                ELSE run END AS word FROM sums)
  WHERE length(word) >= {SHORTEST} GROUP BY word HAVING count(*) >= {LEAST}),
cut AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS one,
               substr(word, 1, i - 1) || substr(word, i + 1) AS less
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
gone AS (SELECT DISTINCT c.word, c.n, w.word AS other, w.n AS other_n FROM cut c JOIN words w ON c.less = w.word),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.one = b.one AND a.word <> b.word
  UNION ALL SELECT word, n, other, other_n FROM gone
  UNION ALL SELECT other, other_n, word, n FROM gone),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS most, min_by(other, (-other_n, other)) AS other FROM near GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {RATIO} * w.n THEN other END AS form,
                 CASE WHEN most >= {RATIO} * w.n THEN most END AS form_n
          FROM words w LEFT JOIN best ON w.word = best.word),
way(word, root) AS (SELECT word, word FROM forms
                    UNION ALL SELECT way.word, forms.form FROM way JOIN forms ON way.root = forms.word WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, way.root, f.n, f.n_near, f.form_n
FROM way JOIN forms f ON way.word = f.word JOIN forms e ON way.root = e.word WHERE e.form IS NULL
"""
