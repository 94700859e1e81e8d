"""N-gram Jaccard join with PartEnum signatures.

A document's set holds its distinct shingles of ``words`` words (A-Z
lower-cased; fewer words: the whole sequence as one). Two documents link when
100 * intersection >= percent * union. The result names the connected
component of every document.

Signatures. Linked sets of sizes up to r differ in at most
k = 2 r (100 - percent) / (100 + percent) shingles. Sizes are cut into bands;
a set signs for its own band and, if a larger partner can be in the next, for
that one. In a band the domain of shingles is hashed into n1 partitions of n2
cells. With n1 = k // (k2 + 1) + 1 + spare partitions, two linked sets differ
by at most k2 in 1 + spare of them, so there they agree on some n2 - k2 cells:
a signature is a partition's choice of that many cells, hashed with the shingles
in them, and linked sets share at least 1 + spare. A choice without a shingle says
nothing and would gather much of a band, so a set signs it only if more than
``spare`` of its partitions have such a choice. A linked pair then shares 1 + spare
less the partitions of that kind that either has, 1 at least (``need``).

Equal sets form classes, and only one of each task's copies signs. Sets under
a signature make a bucket; a set in fewer buckets than it needs links with
nothing. Every set also has an odd sketch, one parity bit per hashed shingle:
two sketches differ in no more bits than the sets differ in shingles, so pairs
whose sketches differ in more than k bits are left without a look at the sets.
Buckets are never expanded into all pairs:

1. star: sets are compared exactly with their buckets' centre, the set that
   stands in most buckets (in a group of near copies, the one closest to all);
   links give components;
2. rest: where a bucket still has several components, all pairs across
   components that share the signatures they need and pass their sketches are
   compared exactly. In huge buckets, sets go first that cannot link: a
   shingle that only one component has cannot be shared across, and enough
   must be shared.

Only the sets of pairs that get as far as the exact comparison are gathered.

So every link between components is found, and the work is that of the pairs
that can still matter. Signatures seen very often in a part of the documents
are split over tasks by a salt; that part only decides who is salted, not what
is compared.

Null, empty and blank texts have empty sets (0 shingles) and link with
nothing, not even each other. Null doc_ids count as larger than all others: a
component of only such rows has a null id. Repeated rows are copies. Sets,
classes and shingles are known by 64-bit hashes. Extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyflow.llm.common import join_groups, small_batches, stage, wrapped
from tallyflow.llm.components import components

SALTS = 64
HOT_PART = 64            # one document in so many decides which signatures are salted
HOT_COUNT = 64           # signatures that so many of them have
LARGE = 50               # members over which a bucket's pairs are made with their sketches
HUGE = 500               # members over which unshared shingles are looked at first
SIGNATURE = np.uint64((1 << 48) - 1)      # bits of a signature; chance meetings cost a look only
SKETCH = 16              # words of 64 bits of a sketch
SEEN = 200_000           # classes a task remembers to have signed
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = x + np.uint64((seed + 1) * GOLD & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


# A word's hash is a polynomial over its bytes, each byte a fixed random number
# (0 for the space characters, one number for both cases of a letter).
BASE = 0x9E3779B97F4A7C15
SLICE = 1 << 20
BYTE = mix(np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64), 3) | np.uint64(1)
BYTE[[9, 10, 11, 12, 13, 32]] = 0
_powers = np.ones((2, 1), dtype=np.uint64)


def _power(n: int) -> np.ndarray:
    """Powers of the base and of its inverse, n at least."""
    global _powers
    if _powers.shape[1] < n:
        n = 1 << (n - 1).bit_length()
        steps = np.full((2, n), [[BASE], [pow(BASE, -1, 1 << 64)]], dtype=np.uint64)
        steps[:, 0] = 1
        _powers = np.multiply.accumulate(steps, axis=1)
    return _powers


def word_hashes(data: bytes) -> np.ndarray:
    """The hashes of the words of a text, in order. Long texts go slice by
    slice, cut at a space."""
    out, at = [], 0
    while at < len(data):
        end = len(data)
        if end - at > SLICE:
            code = BYTE[np.frombuffer(data, np.uint8, SLICE, at)]
            spaces = np.flatnonzero(code == 0)
            while not len(spaces) and end - at > len(code):
                code = BYTE[np.frombuffer(data, np.uint8, min(2 * len(code), end - at), at)]
                spaces = np.flatnonzero(code == 0)
            end = at + int(spaces[-1]) + 1 if len(spaces) else end
        code = BYTE[np.frombuffer(data, np.uint8, end - at, at)]
        word = np.concatenate([[False], code != 0, [False]])
        edge = np.flatnonzero(word[1:] != word[:-1])
        first, last = edge[::2], edge[1::2]
        power = _power(len(code))
        total = np.append(np.uint64(0), np.cumsum(code * power[0, :len(code)], dtype=np.uint64))
        out.append(mix((total[last] - total[first]) * power[1, first], 2))
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def shingles(text: str | None, words: int) -> np.ndarray:
    """The text's set as sorted distinct hashes."""
    h = word_hashes((text or "").encode())
    k = min(words, len(h))
    if not k:
        return h
    out = mix(h[:len(h) - k + 1], k)
    for j in range(1, k):
        out = mix(out * np.uint64(31) + h[j:len(h) - k + 1 + j], j)
    return np.unique(out)


def sketch(s: np.ndarray) -> np.ndarray:
    """The parity bits of a set."""
    bit = (mix(s, 77) >> np.uint64(64 - (SKETCH * 64 - 1).bit_length())).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=SKETCH * 64) & 1).astype(np.uint8)).view(np.int64)


def set_hash(s: np.ndarray) -> int:
    """The class of a set, as a signed 64-bit number."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


@dataclass(frozen=True)
class Scheme:
    """The signature scheme of a similarity of ``percent``."""
    percent: int = 80
    n2: int = 3
    k2: int = 1

    @cached_property
    def bands(self) -> np.ndarray:
        """The smallest size of each band. Wide bands sign less often for the
        next one, narrow ones put more shingles into a choice of cells."""
        lows = [1]
        while lows[-1] < 1 << 40:
            lows.append(max(lows[-1], int(lows[-1] * (100 / self.percent) ** 1.5)) + 1)
        return np.array(lows)

    def partitions(self, band: int) -> tuple[int, int]:
        """n1 and spare; n1 is 0 where different sets cannot link."""
        high = int(self.bands[band + 1]) - 1
        k = 2 * high * (100 - self.percent) // (100 + self.percent)
        if k < 1:
            return 0, 0
        n1 = k // (self.k2 + 1) + 1
        spare = max(n1 // 6, int(n1 >= 3))
        return n1 + spare, spare

    def _bands(self, size: int) -> list[int]:
        """The bands that a set of this size signs for."""
        band = int(np.searchsorted(self.bands, size, side="right")) - 1
        more = size * 100 // self.percent >= self.bands[band + 1]
        return [b for b in range(band, band + 1 + int(more)) if self.partitions(b)[0]]

    def _choices(self, s: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The cell of each shingle; which choices of cells have a shingle, per
        partition; how many partitions lack one for some choice."""
        n1, _ = self.partitions(band)
        cell = (mix(s, 1000 + band) % np.uint64(n1 * self.n2)).astype(np.int64)
        count = np.bincount(cell, minlength=n1 * self.n2).reshape(n1, self.n2)
        have = np.stack([count[:, c].sum(axis=1) for c in self.picks], axis=1) > 0
        return cell, have, int((~have.all(axis=1)).sum())

    @cached_property
    def picks(self) -> list[list[int]]:
        return [list(c) for c in combinations(range(self.n2), self.n2 - self.k2)]

    def need(self, s: np.ndarray) -> int:
        """How many signatures a set shares at least with one that it links
        with and does not equal."""
        spare = {b: self.partitions(b)[1] for b in self._bands(len(s))}
        return min((max(1, 1 + n - self._choices(s, b)[2]) for b, n in spare.items()), default=1)

    def sign(self, s: np.ndarray) -> np.ndarray:
        """The signatures of a set."""
        signed = [self._sign(s, b) for b in self._bands(len(s))]
        return np.concatenate(signed) if signed else np.zeros(0, dtype=np.uint64)

    def _sign(self, s: np.ndarray, band: int) -> np.ndarray:
        n1, spare = self.partitions(band)
        cell, have, weak = self._choices(s, band)
        sums = np.zeros(n1 * self.n2, dtype=np.uint64)
        np.add.at(sums, cell, mix(s, 99))
        sums = sums.reshape(n1, self.n2)
        total = np.stack([sums[:, c].sum(axis=1, dtype=np.uint64) for c in self.picks], axis=1)
        name = np.arange(total.size, dtype=np.uint64) + np.uint64(band << 40)
        out = mix(total.ravel() ^ mix(name, 7), 8) & SIGNATURE
        return out if weak > spare else out[have.ravel()]


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows).view(np.int64)))


# -- passes over the texts ----------------------------------------------------------

def profiles(docs: DataFrame, words: int, scheme: Scheme) -> DataFrame:
    """doc_id, th (text hash), n (set size), h (class; null without a set),
    need (see ``Scheme``), sk (sketch)."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t, words) for t in b.column("text").to_pylist()]
            if sets:
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id"), b.column("th"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([scheme.need(s) for s in sets], pa.int32()),
                    _lists([sketch(s) for s in sets])], ["doc_id", "th", "n", "h", "need", "sk"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text").mapInArrow(
        of, "doc_id long, th long, n long, h long, need int, sk array<long>")


def signatures(docs: DataFrame, words: int, scheme: Scheme, hot: np.ndarray | None = None) -> DataFrame:
    """(sig, h, salt) of the classes; salt is -1 but for signatures in ``hot``."""
    shared = docs.sparkSession.sparkContext.broadcast(np.zeros(0, np.int64) if hot is None else hot)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            sigs, hs = [], []
            for t in b.column("text").to_pylist():
                s = shingles(t, words)
                h = set_hash(s)
                if not len(s) or h in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(h)
                sigs.append(scheme.sign(s).view(np.int64))
                hs.append(np.full(len(sigs[-1]), h, dtype=np.int64))
            if sigs:
                sig, h = np.concatenate(sigs), np.concatenate(hs)
                at = np.searchsorted(shared.value, sig)
                is_hot = np.append(shared.value, 0)[at] == sig if len(shared.value) else np.zeros(len(sig), bool)
                is_hot &= at < len(shared.value)
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(h), pa.array(
                    np.where(is_hot, h % SALTS, -1).astype(np.int32))], ["sig", "h", "salt"])

    return docs.select("text").mapInArrow(of, "sig long, h long, salt int")


def hot_signatures(docs: DataFrame, words: int, scheme: Scheme) -> np.ndarray:
    """Signatures that a part of the documents has very often. Their number is
    at most that part's signatures over the least count."""
    part = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(HOT_PART)) == 0)
    count = signatures(part, words, scheme).groupBy("sig").agg(F.count("*").alias("n"))
    n = part.count()
    rows = count.where(F.col("n") >= max(HOT_COUNT, n // 1000)).select("sig").collect()
    return np.sort(np.array([r[0] for r in rows], dtype=np.int64))


def sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(h, s) of the classes in ``wanted`` (h, rep): a bit filter of fixed size
    over the representatives' ids picks the texts that are shingled; then
    exactly the wanted ones are kept, one row each."""
    bits = min(28, max(16, int(wanted.count() * 16).bit_length()))

    def place(ids: np.ndarray) -> np.ndarray:
        return (mix(ids.astype(np.int64).view(np.uint64), 55) >> np.uint64(64 - bits)).astype(np.int64)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field = np.zeros(1 << bits, dtype=bool)
        for b in batches:
            field[place(b["rep"].to_numpy(np.int64))] = True
        yield pd.DataFrame({"bits": [np.packbits(field).tobytes()]})

    field = np.zeros(1 << bits >> 3, dtype=np.uint8)
    for row in wanted.where("rep is not null").select("rep").coalesce(8).mapInPandas(pack, "bits binary").toLocalIterator():
        field |= np.frombuffer(bytes(row["bits"]), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            k = place(b.column("doc_id").fill_null(0).to_numpy())
            hit = (shared.value[k >> 3] >> (7 - (k & 7)).astype(np.uint8) & 1).astype(bool)
            hit |= b.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            hs, sets = [], []
            for t in b.column("text").filter(pa.array(hit)).to_pylist():
                s = shingles(t, words)
                h = set_hash(s)
                if len(s) and h not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(h)
                    hs.append(h)
                    sets.append(s)
            if hs:
                yield pa.RecordBatch.from_arrays([pa.array(hs, pa.int64()), _lists(sets)], ["h", "s"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of, "h long, s array<long>")
    return found.join(wanted.select("h"), "h", "left_semi").groupBy("h").agg(F.first("s").alias("s"))


# -- the join -------------------------------------------------------------------------

def _apart(p: str, q: str) -> Column:
    """In how many bits two sketches differ."""
    bits = [F.bit_count(F.get(p, F.lit(k)).bitwiseXOR(F.get(q, F.lit(k)))) for k in range(SKETCH)]
    return sum(bits[1:], bits[0])


def _can_link(p: str, q: str, percent: int) -> Column:
    """What sizes and sketches of two sides allow."""
    n, m = F.col(f"{p}.n"), F.col(f"{q}.n")
    return _sizes(p, q, percent) & (_apart(f"{p}.sk", f"{q}.sk") * (100 + percent) <= (n + m) * (100 - percent))


def _sizes(p: str, q: str, percent: int) -> Column:
    n, m = F.col(f"{p}.n"), F.col(f"{q}.n")
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _verified(pairs: DataFrame, docs: DataFrame, stats: DataFrame, words: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) that link: sketches first, then the whole sets."""
    side = {x: stats.select(F.col("h").alias(x), F.struct("n", "sk").alias("of_" + x)) for x in "ab"}
    pairs = stage(pairs.select("a", "b").join(side["a"], "a").join(side["b"], "b")
                  .where(_can_link("of_a", "of_b", percent)).select("a", "b"), f"{name}-pairs")
    wanted = pairs.select(F.col("a").alias("h")).unionByName(pairs.select(F.col("b").alias("h"))).distinct()
    sets = stage(sets_of(docs, stage(wanted.join(stats.select("h", "rep"), "h"), f"{name}-wanted"), words), f"{name}-sets")
    left = sets.select(F.col("h").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("h").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return stage(pairs.join(left, "a").join(right, "b")
                 .select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb")).alias("n"))
                 .where(100 * F.col("i") >= percent * (F.col("n") - F.col("i"))).select("a", "b"), f"{name}-links")


def roots_of(docs: DataFrame, classes: DataFrame, words: int, scheme: Scheme) -> DataFrame:
    """(node, root) of the classes (h, n, need, sk, rep) that link with others."""
    percent = scheme.percent
    docs = docs.select("doc_id", "text")
    signed = signatures(docs, words, scheme, hot_signatures(docs, words, scheme))
    w = Window.partitionBy("sig", "salt")
    rows = stage(signed.withColumns({"lo": F.min("h").over(w), "hi": F.max("h").over(w)})
                 .where("salt >= 0 or lo <> hi").select("sig", "salt", "h").distinct(), "buckets")
    stats = stage(rows.groupBy("h").agg(F.count("*").alias("deg")).join(classes, "h")
                  .where("deg >= need"), "bucket-sets")
    rows = stage(rows.join(stats.select("h", "deg", "n", "need"), "h").drop("salt"), "buckets-deg")
    # star: the set in most buckets is a bucket's centre
    groups = stage(rows.groupBy("sig").agg(F.max(F.struct("deg", "h"))["h"].alias("b"), F.count("*").alias("size"))
                   .where("size > 1"), "bucket-centres")
    pairs = (join_groups(rows, groups, ["sig"], "size").where("h <> b")
             .groupBy(F.col("h").alias("a"), "b", "need").agg(F.count("*").alias("c")).where("c >= need"))
    star = _verified(pairs, docs, stats, words, percent, "star")
    comp = stage(components(star), "star-components")
    # rest: buckets of several components
    rows = stage(rows.join(comp.withColumnRenamed("node", "h"), "h", "left").select(
        "sig", "h", "n", "need", F.coalesce("root", "h").alias("c")), "buckets-comp")
    open_ = stage(rows.groupBy("sig").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count("*").alias("size"))
                  .where("c0 <> c1").select("sig", "size"), "open-buckets")
    rows = stage(join_groups(rows, open_, ["sig"], "size"), "open-rows")
    able = rows.groupBy("h", "need").agg(F.count("*").alias("deg")).where("deg >= need").select("h")
    rows = stage(rows.join(able, "h", "left_semi"), "open-able")
    rows = _without_unshared(rows, docs, stats, words, percent)
    small = rows.where(F.col("size") <= LARGE)
    large = rows.where(F.col("size") > LARGE).join(stats.select("h", "sk"), "h")
    pairs = (_across(small, _sizes("p", "q", percent)).unionByName(_across(large, _can_link("p", "q", percent)))
             .groupBy("a", "b").agg(F.count("*").alias("c"), F.max("need").alias("need")).where("c >= need"))
    rest = _verified(pairs, docs, stats, words, percent, "rest")
    return components(star.unionByName(rest)) if rest.head(1) else comp


def _across(rows: DataFrame, can: Column) -> DataFrame:
    """Pairs (a, b) of a bucket's sets in different components that ``can``
    link, once per bucket, with the signatures they need."""
    p, q = rows.alias("p"), rows.alias("q")
    on = ((F.col("p.sig") == F.col("q.sig")) & (F.col("p.h") < F.col("q.h")) & (F.col("p.c") != F.col("q.c")) & can)
    return p.join(q, on).select(F.col("p.h").alias("a"), F.col("q.h").alias("b"),
                                F.greatest("p.need", "q.need").alias("need"))


def _without_unshared(rows: DataFrame, docs: DataFrame, stats: DataFrame, words: int, percent: int) -> DataFrame:
    """``rows`` (sig, h, n, c, size, ...) without the sets of huge buckets that
    share too few shingles with other components of such buckets."""
    huge = stage(rows.where(F.col("size") > HUGE).select("h", "n", "c").distinct(), "huge-sets")
    if not huge.head(1):
        return rows
    sets = sets_of(docs, stage(huge.select("h").join(stats.select("h", "rep"), "h"), "huge-wanted"), words)
    each = stage(huge.join(sets, "h").select("h", "c", F.explode("s").alias("x")), "huge-shingles")
    common = stage(each.groupBy("x").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count("*").alias("size"))
                   .where("c0 <> c1").select("x", "size"), "huge-common")
    left = join_groups(each.select("h", "x"), common, ["x"], "size").groupBy("h").agg(F.count("*").alias("m"))
    able = huge.join(left, "h").where(100 * F.col("m") >= percent * F.col("n")).select("h")
    few = rows.where(F.col("size") <= HUGE)
    return stage(few.unionByName(rows.where(F.col("size") > HUGE).join(able, "h", "left_semi")), "open-left")


def classified(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, th (text hash), n, size (documents with
    the same set), root (the component's name), component_id. Without a set,
    root is null."""
    small_batches(docs.sparkSession)
    scheme = Scheme(percent)
    keyed = stage(profiles(docs, words, scheme), "profiles")
    classes = stage(keyed.where("h is not null").groupBy("h").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("size"),
        *(F.first(c).alias(c) for c in ("n", "need", "sk"))), "classes")
    keyed = keyed.select("doc_id", "th", "n", "h")
    comp = roots_of(docs, classes, words, scheme)
    named = stage(classes.join(comp.withColumnRenamed("node", "h"), "h", "left").select(
        "h", "rep", "size", F.coalesce("root", "h").alias("root")), "class-roots")
    roots = stage(named.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("k")), "roots")
    named = stage(join_groups(named, roots, ["root"], "k").select("h", "size", "root", "component_id"),
                  "class-components")
    full = join_groups(keyed.where("h is not null"), named, ["h"], "size").drop("h")
    none = keyed.where("h is null").select("doc_id", "th", "n", F.lit(1).cast("long").alias("size"),
                                           F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id"))
    return full.select(none.columns).unionByName(none)


def join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    doc_id that links reach), class_size (documents with the same set)."""
    return classified(docs, words, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("size").alias("class_size"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest
    doc_id (then text hash; null ids last), and all documents without a set.
    Rows that repeat doc_id and text count once."""
    rows = stage(classified(docs, words, percent), "classified")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th"))
    kept = (rows.where("root is not null").groupBy("root").agg(first.alias("one")).select("one.doc_id", "one.th")
            .unionByName(rows.where("root is null").select("doc_id", "th").distinct()))
    no_null = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    kept = stage(kept.select(no_null.alias("id"), "th"), "kept")
    out = wrapped(docs, id=no_null, th=F.xxhash64("text")).join(kept, ["id", "th"], "left_semi")
    w = Window.partitionBy("id", "th").orderBy("id")
    return out.withColumn("nth", F.row_number().over(w)).where("nth = 1").select("_row.*")
