"""Token files: independent zstandard frames with a trailing seek table.

A file holds the token ids of consecutive documents as little-endian unsigned
32-bit integers. Every document starts a new frame; a document of more than
``frame_tokens`` ids spans several, so a reader decompresses only the frames of
the documents it asks for, one bounded frame at a time. The layout:

    data frames | index frame (skippable) | seek table (skippable)

The seek table is that of the public zstandard seekable format: per frame the
compressed size, the decompressed size and the low 32 bits of the xxh64 of the
content, then the number of frames, a descriptor byte (checksums on) and the
format's magic number as the last four bytes. Any zstandard decoder reads the
whole file. The index frame names the documents: part and shard number, ids of
the part before this shard, and per document its id, first frame and number of
ids, closed by an xxh64 of the index.

``write`` sorts documents by doc_id over the cluster (range partitions) and
encodes each text once. A part's documents go to shards of about
``shard_bytes``, so a task holds one shard, never a whole part. Null texts
count as empty; null doc_ids come first and are kept as null; rows that repeat
a doc_id are all written, in the order of their texts' hashes. An empty table
gives no file and no row. Columns other than doc_id and text play no part.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyflow.llm.blobfiles import read_files, write_files
from tallyflow.llm.common import partitions, small_batches, stage

# Fixed values of the public zstandard frame and seekable formats.
SEEK_MAGIC = 0x8F92EAB1
SEEK_FRAME_MAGIC = 0x184D2A5E
INDEX_FRAME_MAGIC = 0x184D2A50
CHECKSUM_FLAG = 0x80
TAIL = struct.pack("<I", SEEK_MAGIC)

_SKIP = struct.Struct("<II")
_SEEK = struct.Struct("<III")
_FOOT = struct.Struct("<IBI")
_HEAD = struct.Struct("<IIQI")          # part, shard, ids of the part before, documents
_DOC = struct.Struct("<?qIQ")           # null id, doc_id, first frame, ids

TOKEN_BYTES = 4
FRAME_TOKENS = 1 << 20
SHARD_BYTES = 8 << 20
CACHE_WORDS = 500_000
JOINED = 200
SPACE = "\u0120"                        # how a byte-level vocabulary writes a space


# -- the tokenizer ------------------------------------------------------------

class Encoder:
    """Texts -> their ids, by the tokenizers library.

    A byte-level pre-tokenizer with its usual pattern always ends a piece
    before a space that a non-space follows. Texts are therefore cut there, the
    distinct words of a batch are encoded joined (their ids told apart by the
    space each begins with), and a text's ids are put together from its words'.
    The words last seen are kept, ``CACHE_WORDS`` of them and those of one
    batch at most. Texts with other spacing are encoded whole, as are texts
    that hold one of the tokenizer's added tokens (such as ``<|endoftext|>``) and
    all texts with another tokenizer. Added tokens in a text become their ids,
    as the library does it; with ``special_as_text`` they are plain text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = special_as_text
        spec = json.loads(self.tok.to_str())
        self.added = sorted({t["content"] for t in spec.get("added_tokens") or [] if t["content"]})
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                        and not pre.get("add_prefix_space") and spec.get("normalizer") is None)
        self.begins = np.zeros(self.tok.get_vocab_size(with_added_tokens=True), dtype=bool)
        self.begins[[i for t, i in self.tok.get_vocab().items() if t.startswith(SPACE)]] = True
        self.words = pa.array([], pa.string())          # kept words, their ids and
        self.ids = np.zeros(0, dtype="<u4")             # where those begin
        self.ends = np.zeros(1, dtype=np.int64)
        self.seen = np.zeros(0, dtype=np.int64)         # the batch that last had the word
        self.batch = 0

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4")
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _places(self, words: pa.StringArray) -> np.ndarray:
        """Where each distinct word stands among the kept ones; new words are added."""
        self.batch += 1
        if len(self.words) > CACHE_WORDS:
            last = np.sort(self.seen)[-(CACHE_WORDS // 2)]
            keep = np.flatnonzero(self.seen >= last)
            self.ids = _gather(self.ids, self.ends, keep)
            self.ends = np.append(0, np.cumsum(np.diff(self.ends)[keep]))
            self.words, self.seen = self.words.take(pa.array(keep)), self.seen[keep]
        place = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(place))
        if len(new):
            some = new.to_pylist()
            joined = self.whole([" " + " ".join(some[k:k + JOINED]) for k in range(0, len(some), JOINED)])
            ids = np.concatenate(joined)
            begin = np.flatnonzero(self.begins[ids])
            if len(begin) != len(some):
                raise ValueError("the tokenizer does not begin each word with a space")
            self.ends = np.concatenate([self.ends[:-1], begin + len(self.ids), [len(self.ids) + len(ids)]])
            self.ids = np.concatenate([self.ids, ids])
            self.words = pa.concat_arrays([self.words, new])
            self.seen = np.append(self.seen, np.full(len(some), self.batch))
            place = pc.index_in(words, value_set=self.words)
        place = place.to_numpy().astype(np.int64)
        self.seen[place] = self.batch
        return place

    def __call__(self, texts: pa.StringArray) -> list[bytes]:
        if not self.by_word or not len(texts):
            return [x.tobytes() for x in self.whole(texts.to_pylist())]
        cut = pc.split_pattern(texts, " ")
        starts = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        # a space before another space or at the end leaves a piece that is
        # empty or begins with one: such texts are encoded whole, as are those
        # with an added token
        first = pc.utf8_slice_codeunits(words, 0, 1)
        odd = pc.or_(pc.equal(first, ""), pc.utf8_is_space(first))
        spaced = np.zeros(len(texts), dtype=bool)       # texts with an added token that has a space
        for token in [] if self.tok.encode_special_tokens else self.added:
            if " " in token:
                spaced |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
            else:
                odd = pc.or_(odd, pc.match_substring(words, token))
        odd = odd.to_numpy(zero_copy_only=False)
        whole = np.flatnonzero((np.add.reduceat(odd[at], starts[:-1]) > 0) | spaced)
        place = np.zeros(len(words), dtype=np.int64)
        place[~odd] = self._places(words.filter(pa.array(~odd)))
        heads = self.whole(words.take(pa.array(at[starts[:-1]])).to_pylist())
        pool = np.concatenate([self.ids, *heads])
        ends = np.append(self.ends, len(self.ids) + np.cumsum([len(x) for x in heads]))
        at = place[at]
        at[starts[:-1]] = len(self.words) + np.arange(len(texts))
        out = _gather(pool, ends, at)
        n = np.append(0, np.cumsum(np.diff(ends)[at]))[starts]
        result = [out[i:j].tobytes() for i, j in zip(n, n[1:])]
        for k, x in zip(whole, self.whole(texts.take(pa.array(whole)).to_pylist())):
            result[k] = x.tobytes()
        return result


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """A worker's encoder, kept from task to task with the words it has seen."""
    return Encoder(path)


def _gather(pool: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs ``pool[ends[k]:ends[k + 1]]`` of each k in ``at``, joined."""
    n = np.diff(ends)[at]
    stop = np.cumsum(n)
    return pool[np.repeat(ends[at] - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)]


# -- one file -----------------------------------------------------------------

class ShardWriter:
    """Builds one file in memory, document by document."""

    def __init__(self, part: int, shard: int, before: int, frame_tokens: int, level: int = 3):
        self.part, self.shard, self.before = part, shard, before
        self.step = frame_tokens * TOKEN_BYTES
        self.codec = zstandard.ZstdCompressor(level=level)
        self.data, self.seek, self.docs, self.ids = bytearray(), [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // TOKEN_BYTES
        self.docs.append(_DOC.pack(doc_id is None, doc_id or 0, len(self.seek), n))
        self.ids += n
        for at in range(0, len(ids), self.step):
            piece = ids[at:at + self.step]
            frame = self.codec.compress(piece)
            self.data += frame
            self.seek.append(_SEEK.pack(len(frame), len(piece), _check(piece)))

    def blob(self) -> bytes:
        index = _HEAD.pack(self.part, self.shard, self.before, len(self.docs)) + b"".join(self.docs)
        index += struct.pack("<Q", xxhash.xxh64_intdigest(index))
        self.seek.append(_SEEK.pack(_SKIP.size + len(index), 0, _check(b"")))
        table = b"".join(self.seek)
        return b"".join((self.data, _SKIP.pack(INDEX_FRAME_MAGIC, len(index)), index,
                         _SKIP.pack(SEEK_FRAME_MAGIC, len(table) + _FOOT.size), table,
                         _FOOT.pack(len(self.seek), CHECKSUM_FLAG, SEEK_MAGIC)))


def _check(piece: bytes) -> int:
    return xxhash.xxh64_intdigest(piece) & 0xFFFFFFFF


class ShardReader:
    """Random access to one file: reads the seek table and the index, then
    only the frames of the documents asked for."""

    def __init__(self, f):
        self.f = f
        size = f.seek(0, 2)
        n, flag, magic = _FOOT.unpack(self._at(size - _FOOT.size, _FOOT.size))
        if magic != SEEK_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("not a seekable token file")
        table = self._at(size - _FOOT.size - n * _SEEK.size, n * _SEEK.size)
        self.frames, at = [], 0
        for c, d, check in _SEEK.iter_unpack(table):
            self.frames.append((at, c, d, check))
            at += c
        at, length = self.frames.pop()[:2]
        index = self._at(at + _SKIP.size, length - _SKIP.size)
        if struct.unpack("<Q", index[-8:])[0] != xxhash.xxh64_intdigest(index[:-8]):
            raise ValueError("index checksum differs")
        self.part, self.shard, self.before, docs = _HEAD.unpack_from(index)
        self.docs = [(None if null else i, first, ids) for null, i, first, ids
                     in _DOC.iter_unpack(index[_HEAD.size:_HEAD.size + docs * _DOC.size])]
        self.codec = zstandard.ZstdDecompressor()

    def _at(self, at: int, n: int) -> bytes:
        self.f.seek(at)
        return self.f.read(n)

    def pieces(self, first: int, ids: int) -> Iterator[bytes]:
        """The checked content of the frames of one document."""
        left = ids * TOKEN_BYTES
        while left:
            at, c, d, check = self.frames[first]
            piece = self.codec.decompress(self._at(at, c), max_output_size=d)
            if len(piece) != d or _check(piece) != check:
                raise ValueError(f"checksum of frame {first} differs")
            yield piece
            left, first = left - d, first + 1

    def read(self, doc_id: int | None) -> list[tuple[int, ...]]:
        """The ids of every document of this id."""
        return [struct.unpack(f"<{n}I", b"".join(self.pieces(first, n)))
                for i, first, n in self.docs if i == doc_id]


# -- over the cluster ---------------------------------------------------------

def write(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2,
          frame_tokens: int = FRAME_TOKENS, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode ``docs`` (doc_id, text) and write token files under ``path`` in
    ascending doc_id order; ``end_id`` is appended to each document.

    ``tokenizer``: file of the tokenizers library, on every machine.
    """
    small_batches(docs.sparkSession, 1000)
    n = partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        part, shard, out = TaskContext.get().partitionId(), 0, None
        row = lambda blob: pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["blob"])
        for b in batches:
            for i, e in zip(b.column("doc_id").to_pylist(), encode(b.column("text"))):
                if out is None:
                    out = ShardWriter(part, shard, 0, frame_tokens)
                out.add(i, e + end)
                if len(out.data) >= shard_bytes:
                    yield row(out.blob())
                    shard += 1
                    out = ShardWriter(part, shard, out.before + out.ids, frame_tokens)
        if out is not None and out.docs:
            yield row(out.blob())

    write_files(rows.mapInArrow(shards, "blob binary"), path, TAIL)


def documents_of(content: bytes) -> Iterable[tuple]:
    """Per document of one file: part, place among the part's ids, shard,
    number in the shard, doc_id, ids, crc32 of the id bytes."""
    import io
    r = ShardReader(io.BytesIO(content))
    at = r.before
    for k, (i, first, n) in enumerate(r.docs):
        crc = 0
        for piece in r.pieces(first, n):
            crc = zlib.crc32(piece, crc)
        yield r.part, at, r.shard, k, i, n, crc
        at += n


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Read token files back: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32. Every frame is decompressed and checked.

    A part's place is the sum over the parts before it: one row per part, as
    many as ``spark.sql.shuffle.partitions`` when written.
    """
    names = ["part", "at", "shard", "k", "doc_id", "n_tokens", "ids_crc32"]

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                out = pd.DataFrame(list(documents_of(content)), columns=names)
                yield out.astype({"doc_id": "Int64"})

    rows = stage(read_files(spark, path, TAIL).select("content").mapInPandas(
        digest, "part int, at long, shard int, k int, doc_id long, n_tokens long, ids_crc32 long"),
        "token-digests")
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (rows.groupBy("part").agg(F.max(F.col("at") + F.col("n_tokens")).alias("n"))
             .select("part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before")))
    return (rows.join(F.broadcast(parts), "part")
            .select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens",
                    "ids_crc32"))
