"""URL filters by a trie over reversed host labels and path segments.

A rule is a host, a path and a verdict (``allow`` or ``block``). It fits a url
when the url's host is the rule's or a subdomain of it and the url's path
starts with the rule's, character by character. Of the rules that fit, the one
with the longest host decides, among those the one with the longest path; of
two rules that differ in their verdict only, ``block`` decides. A url that no
rule fits gets ``default``: ``allow``, since entries of a filter list name what
is special.

The trie's first levels are host labels from the right, the levels below a host
are path segments. A rule whose path ends amid a segment hangs at the node of
its whole segments, under the piece of the next one that it asks for (``""``
for a path ending in ``/``). One walk down a url's labels and segments meets
every rule that fits.

The trie is broadcast to the executors. A trie holds ``PIECE_RULES`` rules and
``PIECE_CHARS`` characters at most (a single longer rule is a piece of its
own). A longer list is judged piece by piece, each a broadcast that ends with
its pass over the urls, and a url keeps the better of its decisions, so the
result does not depend on the pieces.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased. Path: from there up to ``?``, ``#`` or the end. Without ``://``, or
for a null url, both are empty. A port, a user name or a final dot is part of
the host. Rules are compared in the same form (host lower-cased A-Z, nulls as
empty); one without host fits every host, one without path every path. Repeated
rules count once. Rules with another verdict than the two raise an error.
Every row of the table gets one row, repeated ones too; columns of the table
named like the operator's are replaced by them; an empty table gives no rows, and
an empty rule list gives ``default`` everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import ascii_lower, stage, wrapped

ALLOW = "allow"
BLOCK = "block"

# The size bound of one broadcast trie.
PIECE_RULES = 100_000
PIECE_CHARS = 8 << 20

RULES = "host string, path string, verdict string"
OUT = ("host", "path", "rule", "verdict")
BEST = "labels int, length int, rule string, verdict string"

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


class Trie:
    """Rules by reversed host labels, then path segments.

    A node is a pair (children, ends); a host's path trie hangs under the
    child ``/``, which no label can be. ``ends`` maps the last, open piece of a
    rule's path to the rule's (number of host labels, path length, text,
    verdict).
    """

    def __init__(self, rules: Iterator[tuple[str, str, str]]):
        self.root: tuple[dict, dict] = ({}, {})
        for where, under, verdict in rules:
            labels = where.split(".")[::-1] if where else []
            *whole, last = under.split("/")
            node = self.root
            for step in [*labels, "/", *whole]:
                node = node[0].setdefault(step, ({}, {}))
            node[1][last] = (len(labels), len(under), where + under, verdict)

    def best(self, where: str, under: str) -> tuple | None:
        """The deciding rule: the deepest host that has a rule whose path
        fits, and there the longest path."""
        found = None
        for at in self._hosts(where):
            found = self._under(at, under) or found
        return found

    def _hosts(self, where: str) -> Iterator[tuple[dict, dict]]:
        """The path tries of the host and its parents, shortest host first."""
        node = self.root
        for label in [*where.split(".")[::-1], None]:
            if "/" in node[0]:
                yield node[0]["/"]
            node = node[0].get(label)
            if node is None:
                return

    @staticmethod
    def _under(node: tuple[dict, dict], under: str) -> tuple | None:
        found = None
        for segment in under.split("/"):
            ends = node[1]
            if ends:
                fits = [x for x in ends if segment.startswith(x)]
                if fits:
                    found = ends[max(fits, key=len)]
            node = node[0].get(segment)
            if node is None:
                break
        return found


def _rules(rules: DataFrame) -> DataFrame:
    """Distinct rules with their piece number; ``block`` before ``allow``."""
    plain = rules.select(ascii_lower(F.coalesce(F.col("host").cast("string"), F.lit(""))).alias("host"),
                         F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
                         F.coalesce(F.col("verdict").cast("string"), F.lit("null")).alias("verdict"))
    return plain.groupBy("host", "path").agg(F.max("verdict").alias("verdict"),
                                             F.collect_set("verdict").alias("said"))


def _tries(rules: DataFrame) -> Iterator[Trie]:
    """Bounded tries, one after the other: the rules come partition by
    partition, ``PIECE_RULES`` of them are held at a time."""
    piece, chars = [], 0
    for r in _rules(rules).toLocalIterator():
        wrong = set(r["said"]) - {ALLOW, BLOCK}
        if wrong:
            raise ValueError(f"rule {r['host']}{r['path']}: verdict {sorted(wrong)}, not {ALLOW!r} or {BLOCK!r}")
        size = len(r["host"]) + len(r["path"])
        if piece and (len(piece) >= PIECE_RULES or chars + size > PIECE_CHARS):
            yield Trie(iter(piece))
            piece, chars = [], 0
        piece.append((r["host"], r["path"], r["verdict"]))
        chars += size
    if piece:
        yield Trie(iter(piece))


def _walk(trie: Trie, where: Column, under: Column, docs: DataFrame) -> Column:
    """The trie's decision on each url as a struct of ``BEST``."""
    shared = docs.sparkSession.sparkContext.broadcast(trie)

    @F.pandas_udf(BEST)
    def walk(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        none = (None, None, None, None)
        found = [shared.value.best(h, p) or none for h, p in zip(hosts, paths)]
        return pd.DataFrame(found, columns=["labels", "length", "rule", "verdict"]).astype(
            {"labels": "Int32", "length": "Int32"})

    return walk(where, under)


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """``pages`` with ``host``, ``path``, the deciding ``rule`` (host and path
    as one text, null without one) and the ``verdict``."""
    rows = wrapped(pages, host=host(F.col(f"`{url_col}`").cast("string")), path=path(F.col(f"`{url_col}`").cast("string")))
    rows = rows.withColumn("best", F.lit(None).cast(f"struct<{BEST.replace(' ', ':').replace(',:', ',')}>"))
    tries, first = _tries(rules), True
    for trie in tries:
        if not first:       # the piece before is done with: its broadcast can go
            rows = stage(rows, "url-verdicts")
        found = _walk(trie, F.col("host"), F.col("path"), pages)
        rows = rows.withColumn("found", found)
        better = F.col("best").isNull() | (F.struct("found.labels", "found.length") > F.struct("best.labels", "best.length"))
        rows = rows.withColumn("best", F.when(F.col("found.rule").isNotNull() & better, F.col("found"))
                               .otherwise(F.col("best"))).drop("found")
        first = False
    kept = [F.col(f"_row.`{c}`") for c in pages.columns if c not in OUT]
    return rows.select(*kept, "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def keep(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """The rows of ``pages`` whose url is allowed, with their own columns."""
    inner = wrapped(pages, url=F.col(f"`{url_col}`"))
    return judge(inner, rules, "url", default).where(F.col("verdict") == ALLOW).select("_row.*")


# The registered query's rules (its contract).
RULE_ROWS = [
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
]

ORACLE = f"""
WITH rules(rhost, rpath, verdict) AS (VALUES {", ".join(repr(r) for r in RULE_ROWS)}),
u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{_URL}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '{_URL}', 2) AS path FROM pages),
fits AS (SELECT page_id, host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
                max_by(verdict, length(rhost || rpath)) AS verdict
         FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
         GROUP BY page_id, host, path)
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM u LEFT JOIN fits f ON u.page_id IS NOT DISTINCT FROM f.page_id AND u.host = f.host AND u.path = f.path
"""
