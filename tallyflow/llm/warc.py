"""WARC archives: a writer with revisit records and a salvage reader.

``write`` puts one record per page into gzip archives, one member per record.
A page whose payload another page has too becomes a revisit record that names
the page with the smallest id; payloads under ``min_bytes`` are always written
in full. The reader checks every record (gzip CRC and length, version line,
header lines and the needed ones, Content-Length, block digest, closing blank lines). After a
failed check it searches for the next valid gzip member or version line, goes
on from there, and logs the bytes between as a quarantined gap. What inflates of
a damaged gzip member is searched too: its records that the damage cannot have
touched are recovered (with the member's offset, and the damage as their reason),
and the member is logged as a gap. A member that inflates to more than
``MEMBER_BYTES`` counts as damaged there. One task reads one archive whole, and
Spark reads files up to 2 GiB.

A null payload counts as empty. Pages without a page_id are always written in
full and nothing refers to them; rows that repeat the smallest page_id and its
payload are all responses. A null url gives no target header. An empty table
gives no archive. Columns other than page_id, url and the payload play no part.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm.blobfiles import read_files, write_files
from tallyflow.llm.common import join_groups, small_batches, stage

# The gzip magic number, the WARC version line, the profile of
# identical payloads, and a gzip member without content (the last bytes of
# every archive).
GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TAIL = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"

DATE = "2024-01-01T00:00:00Z"
SHARD_BYTES = 8 << 20
MEMBER_BYTES = 1 << 30
CHUNK = 1 << 16
CRLF = b"\r\n"
# a header line: a token, a colon, a value without control characters
HEADER = re.compile(rb"([!#$%&'*+.^_`|~0-9A-Za-z-]+):[ \t]*([^\x00-\x08\x0a-\x1f\x7f]*)")
NEEDED = {"warc-type", "warc-record-id", "warc-date", "content-length"}
LIKELY = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# -- writing --------------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    head = CRLF.join((b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                      b"Content-Length: %d" % len(payload), b"", b""))
    revisit = refers_to is not None
    block = head if revisit else head + payload
    name = lambda i: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page/{i}')}>"
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(page_id)),
              ("WARC-Date", DATE), ("WARC-Page-ID", page_id),
              ("WARC-Target-URI", None if url is None else re.sub(r"\s", "%20", url)),
              ("WARC-Payload-Digest", "sha1:" + sha1_base32(payload)),
              ("WARC-Payload-Length", len(payload)),
              ("WARC-Block-Digest", "sha1:" + sha1_base32(block))]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to)),
                   ("WARC-Refers-To-Page-ID", refers_to)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields if v is not None), b"", b""]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(CRLF.join(lines) + block + CRLF * 2) + z.flush()


def revisits(pages: DataFrame, payload: str, min_bytes: int) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload an earlier page has."""
    text = F.coalesce(F.col(payload), F.lit(""))
    rows = stage(pages.where("page_id is not null").select(
        F.col("page_id").cast("long").alias("page_id"), F.unhex(F.sha1(text)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes")), "payload-digests")
    groups = (rows.where(F.col("bytes") >= min_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1"))
    return (join_groups(rows, stage(groups, "payload-groups"), ["digest"], "n")
            .where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct())


def write(pages: DataFrame, path: str, payload: str = "html", min_bytes: int = 0,
          shard_bytes: int = SHARD_BYTES) -> None:
    """Write one record per row of ``pages`` (page_id, url, payload column)."""
    small_batches(pages.sparkSession)
    text = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        text.alias("payload"), F.unhex(F.sha1(text)).alias("digest"))
    known = rows.where("page_id is not null").join(
        revisits(pages, payload, min_bytes), ["page_id", "digest"], "left")
    none = rows.where("page_id is null").withColumn("refers_to", F.lit(None).cast("long"))
    rows = known.unionByName(none).select("page_id", "url", "payload", "refers_to")

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = bytearray()
        whole = lambda x: None if pd.isna(x) else int(x)
        for b in batches:
            for i, url, text, ref in zip(b["page_id"], b["url"], b["payload"], b["refers_to"]):
                out += record(whole(i), url, text.encode(), whole(ref))
                if len(out) >= shard_bytes:
                    yield pd.DataFrame({"blob": [bytes(out) + TAIL]})
                    out.clear()
        if out:
            yield pd.DataFrame({"blob": [bytes(out) + TAIL]})

    write_files(rows.mapInPandas(shards, "blob binary"), path, TAIL)


# -- reading with salvage ---------------------------------------------------------

class Gap(NamedTuple):
    start: int
    end: int
    reason: str


class Record(NamedTuple):
    offset: int
    headers: dict[str, str]
    block: bytes
    damage: str | None = None

    @property
    def payload(self) -> bytes:
        """The block after its HTTP headers, if it has any."""
        if self.headers.get("content-type", "").startswith("application/http"):
            return self.block.partition(CRLF * 2)[2]
        return self.block


class Bad(ValueError):
    """A check that a record fails."""


def parse(data: bytes, at: int) -> tuple[Record, int]:
    """The plain record at ``at`` and the offset after it, or ``Bad``."""
    if not re.compile(rb"WARC/1\.[01]\r\n").match(data, at):
        raise Bad("no version line")
    end = data.find(CRLF * 2, at)
    if end < 0:
        raise Bad("headers do not end")
    headers = {}
    for line in data[at:end].split(CRLF)[1:]:
        m = HEADER.fullmatch(line)
        if not m:
            raise Bad("a line that is no header")
        k = m[1].decode().lower()
        if k in headers and k in NEEDED:
            raise Bad(f"{k} twice")
        headers[k] = m[2].decode("utf-8", "replace").strip()
    if not NEEDED <= headers.keys():
        raise Bad(f"without {', '.join(sorted(NEEDED - headers.keys()))}")
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise Bad("no Content-Length")
    start, stop = end + 4, end + 4 + int(length)
    if data[stop:stop + 4] != CRLF * 2:
        raise Bad("the block does not end where Content-Length says")
    block = data[start:stop]
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:] != sha1_base32(block):
        raise Bad("block digest differs")
    return Record(at, headers, block), stop + 4


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``at`` and the offset after it.

    Fed in chunks: zlib copies what follows the member, here a chunk at most."""
    z, out, view = zlib.decompressobj(31), bytearray(), memoryview(data)
    while not z.eof:
        if at >= len(data):
            raise Bad("gzip: the member is cut off")
        try:
            out += z.decompress(view[at:at + CHUNK])
        except zlib.error as e:
            raise Bad(f"gzip: {e}") from None
        if len(out) > MEMBER_BYTES:
            raise Bad(f"gzip: the member inflates to more than {MEMBER_BYTES} bytes")
        at = min(at + CHUNK, len(data))
    return bytes(out), at - len(z.unused_data)


def _inflated(data: bytes, at: int) -> tuple[bytes, str]:
    """What the damaged member at ``at`` gives before the damage shows, and its
    kind: ``cut`` (the file ends), ``trailer`` (only the length or one byte of
    the checksum is wrong) or ``inside``."""
    z, out, view = zlib.decompressobj(31), bytearray(), memoryview(data)
    while at < len(data) and len(out) <= MEMBER_BYTES:
        before = z.copy()
        try:
            out += z.decompress(view[at:at + CHUNK])
        except zlib.error:
            break
        at += CHUNK
    else:
        return bytes(out), "cut" if at >= len(data) else "inside"
    for k in range(at, min(at + CHUNK, len(data))):
        try:
            out += before.decompress(view[k:k + 1])
        except zlib.error as e:
            differs = (zlib.crc32(out) ^ int.from_bytes(data[k - 3:k + 1], "little")).to_bytes(4, "little")
            trailer = "length check" in str(e) or "data check" in str(e) and sum(map(bool, differs)) == 1
            return bytes(out), "trailer" if trailer else "inside"
    return bytes(out), "inside"


def _recovered(data: bytes, at: int, damage: str) -> list[Record]:
    """The records of the damaged member at ``at`` that can be trusted.

    With a damaged trailer all do. Else a record needs a block digest that is
    right. Headers have no digest, and damage spreads to what is inflated after
    it: with damage inside, only records before one that fails its checks
    count, and where none fails, the damage may be in any header."""
    content, kind = _inflated(data, at)
    good, located = [], False
    for x in salvage(content):
        if isinstance(x, Gap):
            located = True
            if kind == "inside":
                break
        elif kind == "trailer" or x.headers.get("warc-block-digest", "").startswith("sha1:"):
            good.append(x._replace(offset=at, damage=damage))
    return good if kind != "inside" or located else []


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """The records of an archive, gzip members or plain, and the gaps between."""
    at, bad, reason = 0, None, ""
    while at < len(data):
        gzip = data.startswith(GZIP, at)
        try:
            if gzip:
                content, after = _member(data, at)
                found = list(salvage(content)) if content else []
                if content and not any(isinstance(x, Record) for x in found):
                    raise Bad("no record in the gzip member")
                found = [Gap(at, after, x.reason) if isinstance(x, Gap) else x._replace(offset=at) for x in found]
            else:
                one, after = parse(data, at)
                found = [one]
        except Bad as e:
            if bad is None:
                bad, reason = at, str(e)
            if gzip:
                yield from _recovered(data, at, str(e))
            likely = LIKELY.search(data, at + 1)
            at = likely.start() if likely else len(data)
            continue
        if bad is not None:
            yield Gap(bad, at, reason)
            bad = None
        yield from found
        at = after
    if bad is not None:
        yield Gap(bad, len(data), reason)


SCHEMA = ("path string, offset long, gap_bytes long, reason string, page_id long, record_type string, "
          "url string, payload_bytes long, payload_digest string, refers_to long")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of the archives under ``path``; ``gap_bytes`` is null
    for a record, and a gap has no record columns. A record from a damaged
    member has a ``reason``."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for b in batches:
            for p, data in zip(b["path"], b["content"]):
                yield pd.DataFrame([_row(p, x) for x in salvage(bytes(data))], columns=names).astype(
                    {c: "Int64" for c in ("offset", "gap_bytes", "page_id", "payload_bytes", "refers_to")})

    return read_files(spark, path).mapInPandas(rows, SCHEMA)


def _row(path: str, x: Record | Gap) -> tuple:
    if isinstance(x, Gap):
        return (path, x.start, x.end - x.start, x.reason, *[None] * 6)
    h = x.headers
    number = lambda k: int(h[k]) if h.get(k, "").lstrip("-").isdigit() else None
    revisit = h.get("warc-type") == "revisit"
    size = number("warc-payload-length") if revisit else len(x.payload)
    digest = h.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else sha1_base32(x.payload)
    return (path, x.offset, None, x.damage, number("warc-page-id"), h.get("warc-type"),
            h.get("warc-target-uri"), size, digest, number("warc-refers-to-page-id"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
           ((instr('0123456789abcdef', substr(h, (5 * i) // 4 + 1, 1)) - 1) * 16
            + instr('0123456789abcdef', substr(h, (5 * i) // 4 + 2, 1)) - 1) // (2 ** (3 - (5 * i) % 4))::BIGINT
           ) % 32)::INTEGER, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id OR page_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
