"""op5: records read back, revisits, and salvage of damaged archives."""

import random
import zlib

import pytest

from tallyflow.llm import warc


def _archive(n=12, plain=False):
    pages = [(k, f"http://x/{k}", f"<p>page {k} {'é' * k}</p>".encode()) for k in range(n)]
    parts = [warc.record(*p, None) for p in pages]
    if plain:
        parts = [zlib.decompress(p, 31) for p in parts]
    return pages, parts


def _found(data):
    got = list(warc.salvage(data))
    return ([int(r.headers["warc-page-id"]) for r in got if isinstance(r, warc.Record)],
            [(g.start, g.end) for g in got if isinstance(g, warc.Gap)])


@pytest.mark.parametrize("plain", [False, True])
def test_whole_archive(plain):
    pages, parts = _archive(plain=plain)
    data = b"".join(parts) + (b"" if plain else warc.TAIL)
    assert _found(data) == (list(range(12)), [])
    assert [r.payload for r in warc.salvage(data)] == [p for _, _, p in pages]
    # all records in one gzip member
    if plain:
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        assert _found(z.compress(data) + z.flush()) == (list(range(12)), [])


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("kind", ["flip", "cut", "insert", "drop"])
def test_salvage(plain, kind):
    """Damage inside records 3 and 7: the others are recovered, and the gaps
    are the bytes of the damaged ones."""
    rnd = random.Random(kind)
    for _ in range(20):
        _, parts = _archive(plain=plain)
        for k in (3, 7):
            p = bytearray(parts[k])
            # of plain records only the block has a digest; cuts are found anywhere
            low = p.index(b"\r\n\r\n") + 4 if plain and kind != "cut" else 12
            at = rnd.randrange(low, len(p) - 12)
            if kind == "flip":
                p[at] ^= 0x20 if plain else 0xFF
            elif kind == "cut":
                p = p[:at]
            elif kind == "insert":
                p[at:at] = b"\x00garbage\x1f\x8b\x08"
            else:
                del p[at]
            parts[k] = bytes(p)
        records, gaps = _found(b"".join(parts))
        assert records == [k for k in range(12) if k not in (3, 7)]
        start = [sum(map(len, parts[:k])) for k in range(13)]
        assert gaps == [(start[k], start[k + 1]) for k in (3, 7)]


def _one_member(n=20):
    _, parts = _archive(n, plain=True)
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return parts, z.compress(b"".join(parts)) + z.flush()


@pytest.mark.parametrize("chunk", [warc.CHUNK, 7])
def test_records_of_a_damaged_member(monkeypatch, chunk):
    """All records in one member: a bad checksum loses none, a cut only those it
    takes, and the member is logged; the next member is read as ever."""
    monkeypatch.setattr(warc, "CHUNK", chunk)
    _, member = _one_member()
    after = warc.record(77, "u", b"x", None)
    flipped = bytearray(member)
    flipped[-6] ^= 1                                           # of the CRC
    assert _found(bytes(flipped) + after) == ([*range(20), 77], [(0, len(member))])
    got = [r for r in warc.salvage(bytes(flipped) + after) if isinstance(r, warc.Record)]
    assert [r.damage is not None for r in got] == [True] * 20 + [False] and {r.offset for r in got[:20]} == {0}
    records, gaps = _found(member[:-60])
    assert 10 <= len(records) < 20 and records == list(range(len(records))) and gaps == [(0, len(member) - 60)]
    records, gaps = _found(member[:-60] + after)
    assert records[-1] == 77 and len(records) > 10 and gaps == [(0, len(member) - 60)]
    broken = bytearray(member)
    broken[len(member) // 2] ^= 0xFF
    records, gaps = _found(bytes(broken) + after)
    assert records[-1] == 77 and records[:3] == [0, 1, 2] and gaps == [(0, len(member))]


def test_a_member_without_bound(monkeypatch):
    monkeypatch.setattr(warc, "MEMBER_BYTES", 3000)
    small, large = warc.record(1, "u", b"x", None), warc.record(2, "u", b"0" * 10 ** 6, None)
    monkeypatch.setattr(warc, "CHUNK", 64)
    assert _found(small + large + small) == ([1, 1], [(len(small), len(small) + len(large))])


def test_records_without_digest_need_a_sound_member():
    plain = b"".join(_archive(6, plain=True)[1])
    plain = b"\r\n".join(x for x in plain.split(b"\r\n") if not x.startswith(b"WARC-Block-Digest"))
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    member = z.compress(plain) + z.flush()
    assert _found(member) == (list(range(6)), [])
    assert _found(member[:-6] + bytes([member[-6] ^ 1]) + member[-5:]) == (list(range(6)), [(0, len(member))])
    assert _found(member[:-1]) == ([], [(0, len(member) - 1)])
    broken = member[:-12] + bytes([member[-12] ^ 0xFF]) + member[-11:]
    assert _found(broken) == ([], [(0, len(member))])


def test_broken_headers_are_found():
    good = zlib.decompress(warc.record(1, "u", b"x", None), 31)
    for old, new in ((b"WARC-Type", b"WARC-Typo"), (b"WARC-Date: ", b"WARC-Date "), (b"\r\nWARC-Date", b"\rWARC-Date"),
                     (b"Content-Length", b"Content\x00Length"), (b"WARC-Date", b"WARC-Type")):
        assert _found(good.replace(old, new, 1)) == ([], [(0, len(good.replace(old, new, 1)))]), old


def test_salvage_ends():
    _, parts = _archive(3)
    assert _found(b"junk" + b"".join(parts)) == ([0, 1, 2], [(0, 4)])
    data = b"".join(parts)
    assert _found(data + b"WARC/1.1\r\nhalf") == ([0, 1, 2], [(len(data), len(data) + 14)])
    assert _found(b"") == ([], []) and _found(b"nothing here") == ([], [(0, 12)])


SCHEMA = "page_id long, url string, html string, digest string, refers_to long"


def _run(spark, rows, path, min_bytes=0):
    warc.write(spark.createDataFrame(rows, SCHEMA), path, min_bytes=min_bytes, shard_bytes=2000)
    got = warc.read(spark, path)
    assert got.where("gap_bytes is not null").count() == 0
    return sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got.collect()), key=repr)


def test_odd_pages(spark, scratch):
    long_page = "<p>" + "é" * 300_000
    rows = [(5, "u", "same", "x", 1), (2, "u", "same", "x", 1), (2, "u", "same", "x", 1), (9, None, "same", None, None),
            (4, "u v\r\nX: y", None, None, None), (3, "u", "", None, None), (None, "u", "same", None, None),
            (None, None, None, None, None), (7, "u", long_page, None, None)]
    size = len(long_page.encode())
    assert _run(spark, rows, f"{scratch}/a") == sorted([
        (5, 4, "revisit", 2), (2, 4, "response", None), (2, 4, "response", None), (9, 4, "revisit", 2),
        (4, 0, "revisit", 3), (3, 0, "response", None), (None, 4, "response", None), (None, 0, "response", None),
        (7, size, "response", None)], key=repr)
    # only payloads of five bytes or more are revisited
    assert all(t == "response" for _, _, t, _ in _run(spark, rows, f"{scratch}/b", min_bytes=5))
    assert _run(spark, [], f"{scratch}/c") == []
