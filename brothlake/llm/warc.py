"""WARC archives: a writer for pages, and a reader that salvages damaged files.

Each task writes its own archives (a gzip member a record, files of bounded
size) into the shared folder and returns a manifest of them; files of failed
attempts are in no manifest and so never read. The reader checks members,
lengths and digests; where a check fails it searches for the next gzip member
or version line, goes on from there, and logs the bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import io
import logging
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import fresh_path, written

#: An archive is closed when it has so many bytes; a longer record is a file of its own.
ARCHIVE_BYTES = 64 << 20
#: Compression level of a record; the lowest, for the digests and texts are read back at once.
LEVEL = 1
VERSION = b"WARC/1.1"

MANIFEST = "path string, archive_bytes long, records long"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
GAPS = "path string, gap_start long, gap_end long, reason string"

_log = logging.getLogger(__name__)
_MEMBER = b"\x1f\x8b\x08"
_START = re.compile(rb"WARC/1\.[01]\r\n")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def header_value(text: str) -> str:
    """text as one header line: controls and spaces are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), text)


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None = None, revisit: bool = False, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record, uncompressed. A revisit names its response and has the HTTP header but no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    name = "null" if page_id is None else page_id
    lines = [
        VERSION.decode(),
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Target-URI: {header_value(url) if url else f'urn:page:{name}'}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        *([f"WARC-Refers-To: <urn:page:{first}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes
    end: int  # byte after the record


class Gap(NamedTuple):
    start: int
    end: int
    reason: str


def _checked(data: bytes, at: int) -> Record | str:
    """The record at a place, or what is wrong with it."""
    if not _START.match(data, at):
        return "no version line"
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        return "header without end"
    headers = {}
    for line in data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return "bad header line"
        headers[name.strip().lower()] = value.strip()
    if not headers.get("content-length", "").isdigit():
        return "bad length"
    begin = stop + 4
    end = begin + int(headers["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        return "length differs"
    block = data[begin:end]
    kind, _, digest = headers.get("warc-block-digest", "").partition(":")
    if kind == "sha1" and digest != sha1_base32(block):
        return "digest differs"
    return Record(headers, block, end + 4)


def records_of(data: bytes, base: int = 0) -> Iterator[Record | Gap]:
    """Records of uncompressed bytes, and the gaps between them; offsets from ``base`` on."""
    at = 0
    while at < len(data):
        got = _checked(data, at)
        if not isinstance(got, str):
            yield got
            at = got.end
            continue
        found = _START.search(data, at + 1)
        after = found.start() if found else len(data)
        yield Gap(base + at, base + after, got)
        at = after


def unpacked(data: memoryview, at: int) -> tuple[bytes, int, list[tuple[int, int]], str]:
    """What can be inflated of the gzip member at a place, its end, marks (compressed and inflated bytes up to a point, in order), and what is wrong with it, if anything is."""
    reader, out, fed, marks = zlib.decompressobj(31), io.BytesIO(), at, [(at, 0)]
    while not reader.eof and fed < len(data):
        before, part = reader.copy(), data[fed : fed + 16384]
        try:
            out.write(reader.decompress(part))
        except zlib.error as e:
            for i in range(len(part)):  # what the part holds before the damage
                try:
                    out.write(before.decompress(part[i : i + 1]))
                except zlib.error:
                    break
            return out.getvalue(), fed, marks, f"bad member: {e}"
        fed += len(part)
        marks.append((fed, out.tell()))
    return out.getvalue(), fed - len(reader.unused_data), marks, "" if reader.eof else "member without end"


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """All readable records of an archive, packed or not or both, and the quarantined gaps, as offsets in ``data``.

    Of a damaged member the whole records before the damage are given; the gap
    begins where the last of them ends, to the accuracy of one read.
    """
    view, at = memoryview(data), 0
    while at < len(data):
        start = at
        if data[at : at + 3] == _MEMBER:
            inside, end, marks, wrong = unpacked(view, at)
            found = list(records_of(inside))
            if wrong:  # what comes after the last whole record is part of the damage
                while found and isinstance(found[-1], Gap):
                    found.pop()
                whole = found[-1].end if found else 0
                start = max(packed for packed, plain in marks if plain <= whole)
            for x in found:
                yield Gap(at, end, f"in member: {x.reason}") if isinstance(x, Gap) else x
            if not wrong:
                at = end
                continue
            got = wrong
        else:
            got = _checked(data, at)
            if not isinstance(got, str):
                yield got
                at = got.end
                continue
        packed, plain = data.find(_MEMBER, at + 1), _START.search(data, at + 1)
        after = min([x for x in (packed, plain.start() if plain else -1) if x >= 0], default=len(data))
        if start < after:
            yield Gap(start, after, got)
        at = after


def _page(name: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name)
    return int(found[1]) if found else None


def page_row(found: Record) -> tuple | None:
    """What a record tells of its page; None if it is no page's or its payload isn't the one announced."""
    kind = found.headers.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = found.block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length: *(\d+)", http)
    digest = found.headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and digest != sha1_base32(payload):
        return None
    size = len(payload) if kind == "response" else int(length[1]) if length else None
    return _page(found.headers.get("warc-record-id", "")), size, digest, kind, _page(found.headers.get("warc-refers-to", ""))


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else re.sub("^file:/*", "file:///", path) if path.startswith("file:") else f"file://{path}")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of pages (page_id, url, html, first, revisit) in a folder; the manifest of the files."""

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        held, size, files = [], 0, []

        def close() -> None:
            name = f"{root}/{uuid.uuid4().hex}.warc.gz"
            with store.open_output_stream(name, compression=None) as f:
                for part in held:
                    f.write(part)
            files.append((f"{folder}/{name.rpartition('/')[2]}", size, len(held)))

        for batch in batches:
            for page_id, url, html, first, revisit in zip(*(batch[c].astype(object).where(batch[c].notna(), None) for c in ("page_id", "url", "html", "first", "revisit"))):
                packed = member(record(None if page_id is None else int(page_id), url, (html or "").encode(), None if first is None else int(first), bool(revisit)))
                if held and size + len(packed) > archive_bytes:
                    close()
                    held, size = [], 0
                held.append(packed)
                size += len(packed)
        if held:
            close()
        yield pd.DataFrame(files, columns=["path", "archive_bytes", "records"])

    return pages.select(F.col("page_id").cast("string"), "url", "html", F.col("first").cast("string"), "revisit").mapInPandas(kernel, MANIFEST)


def read_back(manifest: DataFrame) -> DataFrame:
    """Rows of the files named in the column path: those of readable page records, and those of gaps, which have a path."""

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                store, name = _store(path)
                with store.open_input_stream(name, compression=None) as f:
                    data = f.read()
                rows = []
                for x in salvage(data):
                    if isinstance(x, Gap):
                        rows.append((None,) * 5 + (path, *x))
                    elif (page := page_row(x)) is not None:
                        rows.append(page + (None,) * 4)
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in f"{READ}, {GAPS}".split(", ")], dtype=object)

    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInPandas(kernel, f"{READ}, {GAPS}")


def read_archives(manifest: DataFrame) -> DataFrame:
    """Page rows of all readable records of the files named in the column path."""
    return read_back(manifest).where("path IS NULL").select(*[c.split()[0] for c in READ.split(", ")])


def read_gaps(manifest: DataFrame) -> DataFrame:
    """Quarantined byte gaps of the files named in the column path."""
    return read_back(manifest).where("path IS NOT NULL").select(*[c.split()[0] for c in GAPS.split(", ")])


def marked_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, first, revisit: of equal payloads of at least ``least_bytes`` bytes all but the smallest page_id revisit it.

    Digests and ids alone are grouped and joined, so the copies of a popular
    payload don't meet in one task; pages get their mark by page_id.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digest = F.when(F.octet_length(payload) >= least_bytes, F.sha1(payload))
    keyed = pages.select("page_id", digest.alias("digest")).where("digest IS NOT NULL").groupBy("page_id", "digest").agg(F.count(F.lit(1)).alias("rows"))
    firsts = keyed.groupBy("digest").agg(F.min("page_id").alias("first"), F.sum("rows").alias("n")).where("n > 1 AND first IS NOT NULL").drop("n")
    marks = keyed.join(firsts, "digest").select(F.col("page_id").alias("id"), F.col("digest").alias("of"), "first")
    marked = pages.select("page_id", "url", "html", digest.alias("digest")).join(marks, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left")
    return marked.select("page_id", "url", "html", "first", (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"))


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Each page as it is read back from the archives written for it: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A null html is an empty payload; a null url is written as the page's own
    name; a null page_id never is the first of its payload's, unless all are
    null, and then all are responses. Rows that repeat a first page's id and
    payload are responses too. A very long page is an archive of its own. An
    empty table gives no archives and no rows; other columns are ignored. Gaps
    found on reading back are logged.
    """
    spark: SparkSession = pages.sparkSession
    manifest = written(write_archives(marked_revisits(pages, least_bytes), fresh_path(spark, "warc")), "warc-manifest")
    rows = written(read_back(manifest), "warc-read")
    for gap in rows.where("path IS NOT NULL").select("path", "gap_start", "gap_end", "reason").toLocalIterator():
        _log.warning("%s: bytes %d to %d quarantined, %s", *gap)
    return rows.where("path IS NULL").select(*[c.split()[0] for c in READ.split(", ")])


def query(spark, sf_dir: str) -> DataFrame:
    return archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _base32_sql(hex_digest: str) -> str:
    """SQL for the base32 text of a 40-digit hex digest: 32 letters, each of 5 bits out of three hex digits at most."""
    letter = f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr({hex_digest} || '00', i * 5 // 4 + 1, 3))::INTEGER) >> (12 - 5 - (i * 5) % 4)) & 31) + 1, 1)"
    return f"list_aggregate(list_transform(range(32), lambda i: {letter}), 'string_agg', '')"


ORACLE = f"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hex FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM p
)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, {_base32_sql('hex')} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""
