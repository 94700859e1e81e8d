"""op1: ids against the library's on whole texts, files round trip, random
access, damage, and the odd cases."""

import io
import os
import struct
import zlib

import public_tokenizers as P
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyflow.llm import token_files as tf
from tallyflow.llm.queries import op1_token_files
from odd_rows import no_docs, odd_docs  # noqa: F401

BPE = P.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(BPE)


PIECES = [*"ab Z9.,'!\n\t\u00e9 \u3000\x1c\x85\u00f1\u4e2d", "'s", "  ", " the", "<|endoftext|>"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=40).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_words_give_the_ids_of_whole_texts(tok, texts):
    got = ENCODER(pa.array(texts, pa.string()))
    assert got == [struct.pack(f"<{len(i)}I", *i) for i in
                   (tok.encode(t, add_special_tokens=False).ids for t in texts)]


ENCODER = tf.Encoder(BPE)


def test_added_tokens_become_their_ids_or_text(tok):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "plain a b", "a <|endoftext|>"]
    own = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(50256 in i for i in own) == 4
    assert ENCODER(pa.array(texts)) == [struct.pack(f"<{len(i)}I", *i) for i in own]
    text = Tokenizer.from_file(BPE)
    text.encode_special_tokens = True
    assert tf.Encoder(BPE, special_as_text=True)(pa.array(texts)) == [
        struct.pack(f"<{len(i)}I", *i) for i in (text.encode(t, add_special_tokens=False).ids for t in texts)]


def test_other_tokenizers_encode_whole_texts():
    path = P.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    texts = ["Hello  World", "", "a b"]
    got = tf.Encoder(path)(pa.array(texts))
    assert got == [struct.pack(f"<{len(i)}I", *i) for i in (t.encode(x, add_special_tokens=False).ids for x in texts)]


def test_cache_is_bounded(tok, monkeypatch):
    monkeypatch.setattr(tf, "CACHE_WORDS", 50)
    e = tf.Encoder(BPE)
    for k in range(6):
        texts = [f"the w{k}a{i} of" for i in range(40)]
        assert [struct.unpack(f"<{len(b) // 4}I", b) for b in e(pa.array(texts))] == [
            tuple(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    assert len(e.words) <= 50 + 42


def _file(docs, frame_tokens=4):
    w = tf.ShardWriter(3, 1, 17, frame_tokens)
    for i, ids in docs:
        w.add(i, struct.pack(f"<{len(ids)}I", *ids))
    return w.blob()


DOCS = [(None, [5]), (-2, []), (4, list(range(11))), (4, [9, 9]), (2 ** 40, [1, 2, 3, 4])]


def test_file_is_plain_zstandard():
    blob = _file(DOCS)
    content = b"".join(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(blob), read_across_frames=True)
                       .read(1 << 20) for _ in range(1))
    assert struct.unpack(f"<{len(content) // 4}I", content) == tuple(x for _, ids in DOCS for x in ids)


class Counting(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        self.taken += n
        return super().read(n)


def test_reader_decompresses_only_what_is_asked(monkeypatch):
    f = Counting(_file(DOCS + [(k, [k] * 400) for k in range(100, 200)]))
    r = tf.ShardReader(f)
    assert (r.part, r.shard, r.before) == (3, 1, 17)
    asked = []
    real = r.codec
    r.codec = type("C", (), {"decompress": lambda self, b, max_output_size: (
        asked.append(1), real.decompress(b, max_output_size=max_output_size))[1]})()
    assert r.read(4) == [tuple(range(11)), (9, 9)] and len(asked) == 4     # 3 frames and 1
    assert r.read(-2) == [()] and r.read(None) == [(5,)] and r.read(77) == []


@pytest.mark.parametrize("at", [6, -60])
def test_damage_is_found(at):
    blob = bytearray(_file([(1, list(range(1000)))], 1 << 20))
    blob[at] ^= 0xFF
    with pytest.raises(Exception):
        tf.ShardReader(io.BytesIO(bytes(blob))).read(1)


def _expected(tok, rows, end=2):
    out, start = [], 0
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [end]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_odd_rows(spark, tok, odd_docs, scratch):
    tf.write(odd_docs, f"{scratch}/t", BPE, frame_tokens=1000, shard_bytes=20_000)
    got = [tuple(r) for r in tf.read_digests(spark, f"{scratch}/t").orderBy("start").collect()]
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted((i, n, c) if i is not None else (-99, n, c) for i, _, n, c in got) == sorted(
        (i, n, c) if i is not None else (-99, n, c) for i, _, n, c in _expected(tok, rows))
    starts = [r[1] for r in got]
    assert starts == [sum(r[2] for r in got[:k]) for k in range(len(got))]


def test_no_rows(spark, no_docs, scratch):
    tf.write(no_docs, f"{scratch}/t", BPE)
    assert tf.read_digests(spark, f"{scratch}/t").count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_query_against_plain_encoding(spark, tok):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    got = sorted(tuple(r) for r in op1_token_files(spark, SF).collect())
    assert got == _expected(tok, rows)
