"""Benchmark decontamination: BM25 over an inverted index of the test items,
searched by every training passage with block-max WAND, then question and
answer overlap.

A text's words are its runs of non-space, lower-cased, without punctuation at
either end. Document frequencies are counted over the whole benchmark. A weight
is scaled so that a score of 1 is ``theta`` of the item's score with itself: an
item is retrieved when its score reaches 1. Scores being relative to the item's
own, BM25's length normalisation is off (b = 0).

Items fall into bands by their number of words (at most 8, 16, 32, ...). A
passage of a band is a window of one and a half times the band's most words,
and windows are half of it apart, so some passage holds any copied item whole.
An item's passages and weights depend on itself, the number of items and its
words' frequencies alone, not on other items' lengths or on pieces.

The search walks pivots as block-max WAND does, all passages of a batch in step:
each term of a passage has a cursor in its postings (sorted by item); in the
order of their items the terms' largest weights are added up, and the first item
where the sum reaches 1 is the pivot. Where the terms' largest weights in the
pivot's block of items do not reach 1 the cursors skip to the next block or
the next term's item; else the pivot is scored in full. Passages none of whose
terms is essential to an item (the heaviest ones, without which no score
reaches 1) do not start. All of these are bounds, so nothing is lost. A retrieved
item is reported when the passage holds at least ``overlap`` of the word n-grams
of its question and of its answer. The question and the answer are the item's
columns of that name if it has them; else the answer is the last sentence, or
the last third of a single sentence.

Executors build the index in pieces of about ``PIECE_POSTINGS`` postings, by a
hash of the item; each piece is broadcast and searched in turn, so a broadcast
is bounded however many items there are, and results are the same for any
number of pieces. Items without a word are left out, rows that repeat an item
count once, and a repeated item_id with another text is an item of its own. A
null or empty text holds no item; ties between passages go to the earlier one.
Repeated documents are searched one by one; extra columns play no part.
"""

from __future__ import annotations

import pickle
import re
import string
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.llm.common import join_groups, small_batches, stage

THETA = 0.7
OVERLAP = 0.6
GRAM = 3
SHORTEST = 8
SEGMENTS = 3
BLOCK_ITEMS = 8
PIECE_POSTINGS = 1 << 20
CELLS = 1 << 20
K1 = 1.2
EPS = 1e-9
PUNCTUATION = string.punctuation + "¡¿«»“”‘’…"


def words_of(text: str) -> list[str]:
    return [x for x in (w.lower().strip(PUNCTUATION) for w in text.split()) if x]


def question_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer; of one sentence, its last third."""
    parts = re.split(r"(?<=[.!?])\s+", text.strip())
    if len(parts) > 1 and words_of(parts[-1]):
        return " ".join(parts[:-1]), parts[-1]
    w = text.split()
    k = max(1, len(w) - len(w) // 3)
    return " ".join(w[:k]), " ".join(w[k:])


def grams(codes: list[int], n: int = GRAM) -> set[tuple[int, ...]]:
    if len(codes) < n:
        return {tuple(codes)} if codes else set()
    return set(zip(*(codes[k:] for k in range(n))))


class Band:
    """The postings of the items of one band of lengths.

    A posting is ``term * n + item``, in order, with its weight; ``block_keys``
    and ``block_most`` are the same by blocks of items, with the largest weight.
    """

    def __init__(self, longest: int, items: list[int], terms: list[np.ndarray], weights: list[np.ndarray], n_terms: int):
        self.stride = max(1, longest // 2)
        self.window = SEGMENTS * self.stride
        self.items, self.n, self.n_terms = items, len(items), n_terms
        of = np.repeat(np.arange(self.n), [len(t) for t in terms])
        term, weight = np.concatenate(terms), np.concatenate(weights)
        order = np.lexsort((of, term))
        term, of, weight = term[order].astype(np.int64), of[order], weight[order]
        self.keys, self.weight = term * self.n + of, weight
        self.ends = np.searchsorted(term, np.arange(n_terms), side="right")
        self.begins = np.searchsorted(term, np.arange(n_terms))
        self.blocks = -(-self.n // BLOCK_ITEMS)
        self.block_keys, at = np.unique(term * self.blocks + of // BLOCK_ITEMS, return_index=True)
        self.block_most = np.maximum.reduceat(weight, at)
        self.most = np.zeros(n_terms)
        np.maximum.at(self.most, term, weight)
        self.essential = np.zeros(n_terms, dtype=bool)
        for t, w in zip(terms, weights):
            heavy = np.argsort(-w, kind="stable")
            # the terms after these weigh less than 1 together
            rest = w.sum() - np.cumsum(w[heavy])
            self.essential[t[heavy[:int(np.argmax(rest < 1 - EPS)) + 1]]] = True

    def _at(self, keys: np.ndarray, values: np.ndarray, want: np.ndarray) -> np.ndarray:
        """The value of each wanted key, 0 where there is none."""
        k = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        return np.where(keys[k] == want, values[k], 0.0)

    def retrieve(self, passages: np.ndarray, begin: np.ndarray, stop: np.ndarray, term: np.ndarray) -> list[tuple]:
        """(passage, item, score) of all that reach 1; a passage's distinct terms
        are ``np.unique(term[begin[s]:stop[s]])``."""
        sets = [np.unique(term[begin[s]:stop[s]]) for s in passages]
        sets = [t[self.begins[t] < self.ends[t]] for t in sets]
        order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
        out, lo = [], 0
        while lo < len(order):
            hi = lo + 1
            while hi < len(order) and (hi + 1 - lo) * len(sets[order[hi]]) <= CELLS:
                hi += 1
            chosen = order[lo:hi]
            width = max(1, len(sets[chosen[-1]]))
            terms = np.full((len(chosen), width), -1, dtype=np.int64)
            for k, c in enumerate(chosen):
                terms[k, :len(sets[c])] = sets[c]
            out += self._walk(passages[chosen], terms)
            lo = hi
        return out

    def _walk(self, passages: np.ndarray, terms: np.ndarray) -> list[tuple]:
        none = terms < 0
        terms = np.where(none, 0, terms)
        cursor = np.where(none, len(self.keys), self.begins[terms])
        ends = np.where(none, 0, self.ends[terms])
        most = np.where(none, 0.0, self.most[terms])
        out: list[tuple] = []
        while len(passages):
            live = cursor < ends
            item = np.where(live, self.keys[np.minimum(cursor, len(self.keys) - 1)] - terms * self.n, self.n)
            order = np.argsort(item, axis=1, kind="stable")
            reach = np.cumsum(np.take_along_axis(np.where(live, most, 0.0), order, 1), axis=1) >= 1 - EPS
            go = reach[:, -1]
            if not go.all():
                passages, terms, cursor, ends, most = (x[go] for x in (passages, terms, cursor, ends, most))
                live, item, order, reach = (x[go] for x in (live, item, order, reach))
                if not len(passages):
                    break
            first = np.argmax(reach, axis=1)[:, None]
            pivot = np.take_along_axis(item, np.take_along_axis(order, first, 1), 1)
            before = live & (item <= pivot)
            block = pivot // BLOCK_ITEMS
            bound = np.where(before, self._at(self.block_keys, self.block_most, terms * self.blocks + block), 0.0).sum(axis=1)
            full = bound >= 1 - EPS
            if full.any():
                score = np.where(before[full], self._at(self.keys, self.weight, terms[full] * self.n + pivot[full]), 0.0).sum(axis=1)
                hit = score >= 1 - EPS
                out += zip(passages[full][hit].tolist(), pivot[full][hit, 0].tolist(), score[hit].round(9).tolist())
            later = np.where(live & ~before, item, self.n).min(axis=1, keepdims=True)
            skip = np.minimum((block + 1) * BLOCK_ITEMS, later)
            target = np.where(full[:, None], pivot + 1, skip)
            moved = np.minimum(np.searchsorted(self.keys, terms * self.n + np.minimum(target, self.n)), ends)
            cursor = np.where(live & (item < target), moved, cursor)
        return out


class Index:
    """The inverted index of a piece of the items, by bands.

    ``items`` are (item_id, question words, answer words, words, weights), the
    weights scaled.
    """

    def __init__(self, items: list[tuple]):
        frequent: dict[str, int] = {}
        for *_, words, _ in items:
            for w in words:
                frequent[w] = frequent.get(w, 0) + 1
        # items with the same frequent words share blocks, so bounds are tight
        items = sorted(items, key=lambda x: (sorted(x[3], key=lambda w: (-frequent[w], w))[:4], x[1], x[2], repr(x[0])))
        self.terms = pa.array(sorted(frequent), pa.string())
        code = {w: i for i, w in enumerate(self.terms.to_pylist())}
        self.ids = [x[0] for x in items]
        self.parts = [tuple(grams([code[w] for w in x]) for x in (q, a)) for _, q, a, _, _ in items]
        bands: dict[int, list[int]] = {}
        for k, (_, q, a, _, _) in enumerate(items):
            bands.setdefault(longest(len(q) + len(a)), []).append(k)
        self.bands = [Band(size, ks, [np.array([code[w] for w in items[k][3]], dtype=np.int64) for k in ks],
                           [np.array(items[k][4], dtype=float) for k in ks], len(code)) for size, ks in sorted(bands.items())]

    def codes(self, words: pa.StringArray) -> np.ndarray:
        """The term of each word; the number of terms for other words, -2 for no word."""
        plain = pc.utf8_trim(pc.utf8_lower(words), characters=PUNCTUATION)
        got = pc.index_in(plain, value_set=self.terms)
        return np.where(pc.equal(plain, "").to_numpy(zero_copy_only=False), -2,
                        pc.fill_null(got, len(self.terms)).to_numpy())

    def search(self, texts: pa.Array, overlap: float = OVERLAP) -> list[tuple]:
        """(row, item, score, question overlap, answer overlap, first word)."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not self.ids or not len(texts):
            return []
        cut = pc.utf8_split_whitespace(texts)
        starts = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        if not len(coded):
            return []
        at = self.codes(coded.dictionary)[coded.indices.to_numpy()]
        keep = at >= -1
        starts = np.append(0, np.cumsum(keep))[starts]
        at = at[keep]
        row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        hits: dict[tuple[int, int], tuple] = {}
        for band in self.bands:
            self._search(band, at, starts, row, overlap, hits)
        return [(*key, *hit) for key, hit in sorted(hits.items())]

    def _search(self, band: Band, at: np.ndarray, starts: np.ndarray, row: np.ndarray, overlap: float, hits: dict) -> None:
        # segments of ``stride`` words; a passage is SEGMENTS of them
        segs = -(-np.diff(starts) // band.stride)
        first = np.append(0, np.cumsum(segs))
        most, essential = np.append(band.most, 0.0), np.append(band.essential, False)
        known = np.flatnonzero(most[at] > 0)
        if not len(known):
            return
        seg = first[row[known]] + (known - starts[row[known]]) // band.stride
        pairs = np.unique(seg * np.int64(len(most)) + at[known])
        seg, term = pairs // len(most), pairs % len(most)
        stop = np.minimum(np.arange(first[-1]) + SEGMENTS, np.repeat(first[1:], segs))
        # a passage's own terms are pairs[begin[s]:begin[stop[s]]]
        begin = np.searchsorted(seg, np.arange(first[-1] + 1))
        reach = np.append(0, np.cumsum(most[term]))
        needed = np.append(0, np.cumsum(essential[term]))
        lo, hi = begin[:-1], begin[stop]
        alive = np.flatnonzero((reach[hi] - reach[lo] >= 1 - 1e-6) & (needed[hi] > needed[lo]))
        for s, k, score in sorted(band.retrieve(alive, lo, hi, term)):
            r = int(np.searchsorted(first, s, side="right")) - 1
            word = int(s - first[r]) * band.stride
            codes = at[starts[r] + word:min(starts[r] + word + band.window, starts[r + 1])].tolist()
            have = grams(codes) | {(c,) for c in codes} | grams(codes, 2)
            item = band.items[k]
            q, a = (len(p & have) / len(p) if p else 1.0 for p in self.parts[item])
            old = hits.get((r, item))
            if q >= overlap and a >= overlap and (old is None or (q + a, score) > (old[1] + old[2], old[0])):
                hits[r, item] = (score, q, a, word)


def longest(words: int) -> int:
    """The most words of an item's band."""
    return max(SHORTEST, 1 << (words - 1).bit_length())


def weighted(benchmark: DataFrame, theta: float = THETA) -> DataFrame:
    """The items as (key, item_id, q, a, posts): their words, and each different
    word with its scaled BM25 weight by the whole benchmark's statistics."""
    both = {"question", "answer"} <= set(benchmark.columns)
    cols = ["question", "answer"] if both else ["text"]

    @F.pandas_udf("q array<string>, a array<string>")
    def words(first: pd.Series, second: pd.Series) -> pd.DataFrame:
        pairs = zip(first, second) if both else map(question_answer, first)
        return pd.DataFrame([(words_of(q), words_of(a)) for q, a in pairs], columns=["q", "a"])

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                            *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in cols]).distinct()
    items = stage(rows.select("item_id", words(cols[0], cols[-1]).alias("w")).select("item_id", "w.*")
                  .where(F.size("q") + F.size("a") > 0).distinct()
                  .withColumn("key", F.xxhash64(F.coalesce("item_id", F.lit(-1)), F.col("item_id").isNull(), "q", "a")), "items")
    n = items.count()
    counts = items.select("key", F.explode(F.concat("q", "a")).alias("word")).groupBy("key", "word").agg(F.count("*").alias("c"))
    df = counts.groupBy("word").agg(F.count("*").alias("n"))
    idf = F.log1p((n - F.col("n") + 0.5) / (F.col("n") + 0.5))
    posts = (join_groups(counts, df, ["word"], "n").withColumn("v", idf * F.col("c") * (K1 + 1) / (F.col("c") + K1))
             .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("word", "v"))).alias("posts")))
    own = theta * F.aggregate("posts", F.lit(0.0), lambda s, x: s + x.v)
    return items.join(posts, "key").withColumn("own", own).select(
        "key", "item_id", "q", "a", F.transform("posts", lambda x: x.word).alias("words"),
        F.transform("posts", lambda x: x.v / F.col("own")).alias("weights"))


def indexes(benchmark: DataFrame, theta: float = THETA) -> Iterator[Index]:
    """The items' index, one bounded piece after the other."""
    items = stage(weighted(benchmark, theta), "weighted-items")
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    piece = F.pmod("key", F.lit(max(1, -(-total // PIECE_POSTINGS))))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        got = [(None if pd.isna(i) else int(i), list(q), list(a), list(w), list(v)) for i, q, a, w, v in
               zip(rows["item_id"], rows["q"], rows["a"], rows["words"], rows["weights"])]
        return pd.DataFrame({"piece": [key[0]], "index": [pickle.dumps(Index(got))]})

    pieces = (items.select(piece.alias("piece"), F.col("item_id").cast("string").alias("item_id"), "q", "a", "words", "weights")
              .groupBy("piece").applyInPandas(build, "piece long, index binary"))
    for r in stage(pieces, "index-pieces").orderBy("piece").toLocalIterator():
        yield pickle.loads(r["index"])


HIT = ("doc_id long, item_id long, score double, question_overlap double, answer_overlap double, "
       "first_word long")


def leaks(docs: DataFrame, benchmark: DataFrame, theta: float = THETA, overlap: float = OVERLAP) -> DataFrame:
    """One row per document and item that a passage of it holds."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for index in indexes(benchmark, theta):
        shared = spark.sparkContext.broadcast(index)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names = [c.split()[0] for c in HIT.split(", ")]
            for b in batches:
                ids = b.column("doc_id")
                found = shared.value.search(b.column("text"), overlap)
                if found:
                    row, item, *rest = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(row)), pa.array([shared.value.ids[k] for k in item], pa.int64()),
                         *(pa.array(x, pa.float64()) for x in rest[:3]), pa.array(rest[3], pa.int64())], names)

        part = rows.mapInArrow(find, HIT)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], HIT) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, theta: float = THETA, overlap: float = OVERLAP) -> DataFrame:
    """``docs`` without the documents that hold a test item."""
    spark = docs.sparkSession
    small_batches(spark)
    for index in indexes(benchmark, theta):
        leaked = _leaked(spark.sparkContext.broadcast(index), overlap)
        docs = docs.where(~leaked(F.col("text")))
    return docs


def _leaked(shared: Broadcast, overlap: float) -> Callable:
    @F.pandas_udf(T.BooleanType())
    def leaked(texts: pd.Series) -> pd.Series:
        found = {h[0] for h in shared.value.search(pa.array(texts, pa.string(), from_pandas=True), overlap)}
        return pd.Series([k in found for k in range(len(texts))], dtype=bool)

    return leaked
