"""Merkle manifest of a dataset as a persistent, path-copying tree.

A document's leaf is the SHA-256 of its doc_id, source, lang, n_chars and text,
each ``-`` if null, else its number of UTF-8 bytes, ``:`` and its value
(integers decimal), joined without a break. Per lang the leaves ascend by
doc_id (null first). While a tree has several nodes, every ``ARITY``
consecutive ones (the last run may be shorter, down to one) become the SHA-256
of their hexadecimal digests, joined. What remains is the lang's subroot; a
lone leaf is one itself. The subroots, by lang (null first, by UTF-8 bytes),
become the root in the same way.

Nodes are never changed. A changed leaf makes a new *version* of the tree that
shares every node but the leaf's ancestors, which it copies. The work follows
aligned blocks of ``SPAN`` = ``ARITY ** LEVELS`` nodes, which are whole
subtrees:

1. ``leaves``: the documents' leaves and their changed leaves, hashed where the
   texts are read, placed by a range partitioning (no lang is one task).
2. ``grow``: every block of leaves becomes its top node; blocks of the tops
   become their tops, and so on up to the root. Each step is a distributed
   pass over ``1 / SPAN`` of the nodes before. On the way down again each top
   learns its *trail*: the siblings on its way to the root.
3. ``versions``: every block is read once more, behind its top's trail. A
   version copies its leaf's ancestors within the block and carries its new
   top on along the trail, so the upper part of all versions is made where
   their leaves are, however many versions meet at the root.

A block's rows are ``SPAN`` at most, and so is what a task holds. A proof is the
siblings of a leaf's way to the root, level by level, left to right.

Defined results: a null doc_id is never the first choice of a tampering rule
(``tampered`` below) and its row is a leaf like others; rows of one lang with
equal doc_ids ascend by leaf, and equal rows are interchangeable; empty and
long texts are hashed whole; columns beyond the five play no part, a missing
one of the five counts as null. An empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyflow.llm.common import ascii_lower, crc32_sql, join_groups, partitions, stage

ARITY = 8
LEVELS = 3
SPAN = ARITY ** LEVELS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# Up to this many rows the places of runs are broadcast, above it joined by key.
RUNS = 50_000

# A trail: on each level the siblings left of the way, then those right of it.
TRAIL = "array<string>"

# Arrow types of the columns that pass through Python.
_ARROW = {"long": pa.int64(), "string": pa.string(), TRAIL: pa.list_(pa.string())}


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(docs: DataFrame, text: Column | None = None) -> Column:
    """The leaf of a row; ``text`` in place of its own."""
    values = {c: F.col(f"`{c}`") if c in docs.columns else F.lit(None) for c in FIELDS}
    if text is not None:
        values["text"] = text
    return F.sha2(F.concat(*[_field(v) for v in values.values()]), 256)


def tampered(docs: DataFrame) -> Column:
    """The leaf of a row after the tampering of the registered query: where 3
    divides the CRC-32 of the decimal doc_id, A-Z of the text lower-cased (a
    null text stays). Null where the rule leaves the row alone."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return F.when(chosen, leaf(docs, ascii_lower(F.col("text"))))


def _places(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` (with a column ``tree``) and ``idx``, their place in their
    tree's order, and ``n``, the tree's number of rows."""
    spark = rows.sparkSession
    by = [F.asc("tree"), *order]
    placed = stage(rows.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
                   .withColumns({"part": F.spark_partition_id(), "mid": F.monotonically_increasing_id()}), "merkle-sorted")
    # one run per tree and partition: no window holds more rows than there are partitions
    runs = placed.groupBy("tree", "part").agg(F.min("mid").alias("first"), F.count("*").alias("size"))
    w = Window.partitionBy("tree")
    before = F.sum("size").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = stage(runs.select("tree", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                             F.sum("size").over(w).alias("n")), "merkle-runs")
    near = F.broadcast(runs) if runs.count() <= RUNS else runs
    return stage(placed.join(near, ["tree", "part"]).withColumn("idx", F.col("mid") + F.col("shift"))
                 .drop("part", "mid", "shift"), "merkle-placed")


def _tree(lang: Column) -> Column:
    """A lang as a key that is never null and sorts null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def leaves(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """One row per document: tree (from its lang), idx, n, doc_id, leaf, and
    ``changed``, the leaf of its new version (null: none). ``docs`` is read
    once; texts are hashed where they are and go no further."""
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    rows = docs.select(_tree(lang).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf(docs).alias("leaf"),
                       (F.lit(None) if changed is None else changed).cast("string").alias("changed"))
    return _places(stage(rows, "merkle-leaves"), [F.asc_nulls_first("doc_id"), F.asc("leaf")])


class Block:
    """The subtree over up to ``ARITY ** height`` consecutive nodes of a tree
    with ``n``: the levels' digests from the bottom to the top. It ends at one
    node; a block of a larger tree always has ``height`` levels above the
    bottom."""

    def __init__(self, bottom: list[str], n: int, height: int = LEVELS):
        self.levels = [bottom]
        while len(self.levels[-1]) > 1 or (n > ARITY ** height and len(self.levels) <= height):
            low = self.levels[-1]
            self.levels.append([digest(low[k:k + ARITY]) for k in range(0, len(low), ARITY)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def trail(self, k: int) -> list[str]:
        """The siblings left and right of the way up from node ``k``."""
        out = []
        for level in self.levels[:-1]:
            lo = k - k % ARITY
            out += ["".join(level[lo:k]), "".join(level[k + 1:lo + ARITY])]
            k //= ARITY
        return out


def copies(node: str, trail: list[str]) -> list[str]:
    """The digests that a version has of its own: the changed leaf ``node`` and
    a copy of each ancestor along ``trail``. It shares all other nodes."""
    out = [node]
    for left, right in zip(trail[::2], trail[1::2]):
        out.append(digest([left, out[-1], right]))
    return out


def _block() -> Column:
    return F.floor(F.col("idx") / SPAN)


def _blocks(rows: DataFrame, each: Callable[[list[tuple]], list[tuple]], schema: str) -> DataFrame:
    """``each`` applied to the rows of every block (columns tree, block, idx
    first), in order of idx. A task reads its blocks one after the other and
    holds one of them and a batch of results."""
    fields = [c.strip().rsplit(" ", 1) for c in schema.split(", ")]
    types = pa.schema([(c, _ARROW[t]) for c, t in fields])

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types.types)], schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        out: list[tuple] = []
        for _, group in itertools.groupby(found, key=lambda r: r[:2]):
            out += each(list(group))
            if len(out) >= SPAN:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    n = partitions(rows.sparkSession)
    return rows.repartition(n, "tree", "block").sortWithinPartitions("tree", "block", "idx").mapInArrow(run, schema)


def _headed(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """tree, block, idx, the columns of ``above`` (one row per block), then
    those of ``nodes``: the nodes of each block behind a first row (idx -1)
    with what is known of the block, so that it is not repeated in each row."""
    of_block = [c for c in above.columns if c not in ("tree", "block")]
    of_node = [c for c in nodes.columns if c not in ("tree", "idx")]
    head = above.select("tree", "block", F.lit(-1).cast("long").alias("idx"), *of_block,
                        *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in of_node])
    body = nodes.select("tree", _block().alias("block"), "idx",
                        *[F.lit(None).cast(above.schema[c].dataType).alias(c) for c in of_block], *of_node)
    return head.unionByName(body)


def grow(nodes: DataFrame) -> DataFrame:
    """The trees over ``nodes`` (tree, idx, n, digest): for each block of them
    (tree, block) its ``top``, the top's ``trail`` to its tree's root, and that
    ``root``."""
    height = LEVELS

    def top(rows: list[tuple]) -> list[tuple]:
        tree, block, _, n, _ = rows[0]
        return [(tree, block, n, Block([r[4] for r in rows], n, height).top)]

    tops = stage(_blocks(nodes.select("tree", _block().alias("block"), "idx", "n", "digest"), top,
                         "tree string, block long, n long, top string"), "merkle-tops")
    done = tops.where(F.col("n") <= SPAN).select("tree", "block", "top", F.array().cast(TRAIL).alias("trail"),
                                                 F.col("top").alias("root"))
    more = tops.where(F.col("n") > SPAN)
    if more.isEmpty():
        return done
    level = more.select("tree", F.col("block").alias("idx"), F.ceil(F.col("n") / SPAN).alias("n"), F.col("top").alias("digest"))
    return done.unionByName(_descend(level, grow(level)).select(
        "tree", F.col("idx").alias("block"), F.col("digest").alias("top"), "trail", "root"))


def _descend(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``nodes`` (tree, idx, n, digest) with their trail to the tree's root:
    within their block, then that of the block's top (``above``, from ``grow``)."""
    height = LEVELS

    def down(rows: list[tuple]) -> list[tuple]:
        (tree, _, _, trail, root, _, _), rest = rows[0], rows[1:]
        block = Block([r[6] for r in rest], rest[0][5], height)
        return [(tree, r[2], r[6], block.trail(k) + trail, root) for k, r in enumerate(rest)]

    return stage(_blocks(_headed(nodes.select("tree", "idx", "n", "digest"), above.select("tree", "block", "trail", "root")),
                         down, f"tree string, idx long, digest string, trail {TRAIL}, root string"), "merkle-trails")


def join_trees(above: DataFrame) -> DataFrame:
    """The tree over the trees' roots: ``above`` (from ``grow``) with each
    top's trail carried on to the whole's ``root``; the tree's is ``subroot``."""
    sizes = above.groupBy("tree").agg(F.first("root").alias("digest"), F.count("*").alias("size"))
    named = sizes.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "digest", "size")
    placed = _places(named, [F.asc("lang")])
    nodes = placed.select("tree", "idx", "n", "digest")
    whole = _descend(nodes, grow(nodes)).select("idx", F.col("trail").alias("upper"), F.col("root").alias("whole"))
    trees = stage(placed.select("idx", F.col("lang").alias("tree"), "size").join(whole, "idx").drop("idx"), "merkle-trees")
    return join_groups(above, trees, ["tree"], "size").select(
        "tree", "block", F.concat("trail", "upper").alias("trail"), F.col("root").alias("subroot"), F.col("whole").alias("root"))


VERSIONS = ("tree string, idx long, doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
            f"copies {TRAIL}")


def versions(rows: DataFrame) -> DataFrame:
    """Per leaf of ``rows`` (from ``leaves``) its version of the whole tree:
    ``copies``, the digests that the version has in place of the leaf and its
    ancestors (the leaf first, the version's root last). A leaf without a change
    is folded with its own digest. ``subroot``, ``root`` and ``proof_sha256``
    (of the siblings, joined) are those of the unchanged tree."""
    above = join_trees(stage(grow(rows.select("tree", "idx", "n", F.col("leaf").alias("digest"))), "merkle-grown"))

    height = LEVELS

    def run(found: list[tuple]) -> list[tuple]:
        (tree, _, _, upper, subroot, root, *_), rest = found[0], found[1:]
        block = Block([r[8] for r in rest], rest[0][6], height)
        out = []
        for k, (_, _, idx, _, _, _, _, doc_id, own, changed) in enumerate(rest):
            trail = block.trail(k) + upper
            out.append((tree, idx, doc_id, own, subroot, root, digest(trail), copies(changed or own, trail)))
        return out

    return _blocks(_headed(rows.select("tree", "idx", "n", "doc_id", "leaf", "changed"),
                           stage(above.select("tree", "block", "trail", "subroot", "root"), "merkle-heads")), run, VERSIONS)


def verify(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """Per document doc_id, leaf, subroot, root, proof_sha256, the root of its
    version (``folded_root``) and whether that is the root (``verified``)."""
    out = versions(leaves(docs, changed)).withColumn("folded_root", F.element_at("copies", -1))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_field(col: str) -> str:
    return f"CASE WHEN {col} IS NULL THEN '-' ELSE octet_length(encode({col}::VARCHAR)) || ':' || {col}::VARCHAR END"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(text if c == "text" else c) for c in FIELDS) + ")"


def _sql_siblings(tree: str) -> str:
    return (f"SELECT a.tree, a.lvl, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, "
            "coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r "
            f"FROM {tree} a JOIN {tree} b ON a.tree = b.tree AND a.lvl = b.lvl AND a.i // 8 = b.i // 8 "
            "WHERE a.n > 1 GROUP BY a.tree, a.lvl, a.i")


def _sql_grow(tree: str) -> str:
    return (f"SELECT tree, lvl + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) "
            f"FROM {tree} WHERE n > 1 GROUP BY tree, lvl, i // 8, n")


def _sql_climb(way: str, siblings: str) -> str:
    return (f"SELECT w.k, w.tree, w.lvl + 1, w.i // 8, sha256(l || h || r), proof || l || r "
            f"FROM {way} w JOIN {siblings} s ON w.tree = s.tree AND w.lvl = s.lvl AND w.i = s.i")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = f"""
WITH RECURSIVE f AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce('=' || lang, '') AS tree, {_sql_leaf("text")} AS leaf,
         CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 3 = 0 THEN {_sql_leaf(_LOWER)} END AS changed
  FROM documents),
base AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                count(*) OVER (PARTITION BY tree) AS n FROM f),
t(tree, lvl, i, n, h) AS (SELECT tree, 0, i, n, leaf FROM base UNION ALL {_sql_grow("t")}),
sub AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u(tree, lvl, i, n, h) AS (SELECT '', 0, i, n, subroot FROM sub UNION ALL {_sql_grow("u")}),
ts AS ({_sql_siblings("t")}),
us AS ({_sql_siblings("u")}),
w(k, tree, lvl, i, h, proof) AS (
  SELECT k, tree, 0, i, coalesce(changed, leaf), '' FROM base UNION ALL {_sql_climb("w", "ts")}),
v(k, tree, lvl, i, h, proof) AS (
  SELECT k, '', 0, sub.i, w.h, proof FROM w JOIN sub ON w.tree = sub.tree JOIN t ON t.tree = w.tree AND t.n = 1 AND t.lvl = w.lvl
  UNION ALL {_sql_climb("v", "us")}),
done AS (SELECT v.k, v.h AS folded_root, sha256(proof) AS proof_sha256, u.h AS root FROM v JOIN u ON u.n = 1 AND u.lvl = v.lvl)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM base JOIN sub ON base.tree = sub.tree JOIN done ON done.k = base.k
"""
