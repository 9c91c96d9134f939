"""WARC archives with an index: records are written one compressed member each, and read by byte range.

Writing: pages with equal payloads share one response record, that of the largest page id; the others are
revisits of it. Tasks write archives of bounded size into a shared folder under names that no other attempt
has, and give an index row per record (file, offset, length, URL, digest) once an archive is closed; the
index, written as Parquet, is what counts, so an archive of a lost attempt is never read.

Reading: selected index rows are brought together by file, sorted by offset, and ranges close to each other
are read at once; every record is then parsed from its own bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capplan.llm.common import shared_folder, ship

#: Bytes after which an archive is closed, least gap between ranges that are read apart, most bytes of one read.
ARCHIVE, GAP, READ = 64 << 20, 64 << 10, 8 << 20
#: The date of records whose page has none.
DATE = "1970-01-01T00:00:00Z"

_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
INDEX = (
    "file string, offset long, length long, url string, digest string, page_id long, payload_bytes long, record_type string"
)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None, sha: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{sha}')}>"


def record(page: int | None, url: str | None, payload: bytes, response: int | None, date: str = DATE) -> tuple[bytes, str, str]:
    """A record (not compressed), its digest and its type; ``response`` is the page that holds the payload."""
    sha = digest(payload)
    kind = "response" if response is None or response == page else "revisit"
    target = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(page, sha),
        "WARC-Date": date,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha1:{sha}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if page is not None:
        fields["X-Page-Id"] = str(page)
    if kind == "revisit":
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["WARC-Refers-To"] = record_id(response, sha)
        fields["X-Refers-To-Page-Id"] = str(response)
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n", sha, kind


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Header fields, fields of the HTTP message and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    found = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _archives(batches: Iterator[pa.RecordBatch], folder: str, limit: int) -> Iterator[pa.RecordBatch]:
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    out, name, at, rows = None, "", 0, []
    names = [c.split()[0] for c in INDEX.split(", ")]

    def closed() -> pa.RecordBatch:
        out.close()
        return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=_INDEX)

    for batch in batches:
        for page, url, html, response in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if out is None:
                name = f"{uuid.uuid4()}.warc.gz"
                out, at, rows = system.open_output_stream(f"{path}/{name}", compression=None), 0, []
            payload = (html or "").encode()
            raw, sha, kind = record(page, url, payload, response)
            squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
            packed = squeeze.compress(raw) + squeeze.flush()
            out.write(packed)
            rows.append((name, at, len(packed), url, sha, page, len(payload), kind))
            at += len(packed)
            if at >= limit:
                yield closed()
                out = None
    if out is not None:
        yield closed()


_INDEX = pa.schema(
    [
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("url", pa.string()),
        ("digest", pa.string()),
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("record_type", pa.string()),
    ]
)


def write_archives(pages: DataFrame, folder: str | None = None, archive: int = ARCHIVE) -> tuple[DataFrame, str]:
    """Writes a record per row of ``pages`` (``page_id, url, html``); returns the index and the folder.

    NULL html is an empty payload, NULL url an empty target. Pages with equal payloads, the empty one too, are
    revisits of the page with the largest id among them; rows without id revisit it as well, and are responses
    where no page with the payload has an id. Repeated rows give records each. No rows give an empty index.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4()}"
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("sha", F.sha1("html"))
    # only payloads of several pages need to be known to their writers; Spark broadcasts them if they are few
    several = rows.groupBy("sha").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1")
    several.select("sha", "response").write.parquet(f"{folder}/several")
    known = spark.read.parquet(f"{folder}/several")
    told = rows.join(known, "sha", "left").select("page_id", "url", "html", "response")
    index = told.mapInArrow(partial(_archives, folder=f"{folder}/archives", limit=archive), INDEX)
    index.write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index"), f"{folder}/archives"


_RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _records(batches: Iterator[pa.RecordBatch], folder: str, payload: bool) -> Iterator[pa.RecordBatch]:
    """Index rows come sorted by file and offset."""
    system, path = fs.FileSystem.from_uri(folder)
    name, source = None, None
    names = [c.split()[0] for c in _RECORD.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    for batch in batches:
        rows = list(zip(*[batch.column(c).to_pylist() for c in ("file", "offset", "length", "url")], strict=True))
        k = 0
        while k < len(rows):
            file, first, size, _ = rows[k]
            end, j = first + size, k + 1
            while j < len(rows) and rows[j][0] == file and rows[j][1] - end <= GAP and rows[j][1] + rows[j][2] - first <= READ:
                end = max(end, rows[j][1] + rows[j][2])
                j += 1
            if file != name:
                if source is not None:
                    source.close()
                name, source = file, system.open_input_file(f"{path}/{file}")
            source.seek(first)
            data = source.read(end - first)
            out = []
            for _, offset, length, url in rows[k:j]:
                raw = zlib.decompress(data[offset - first : offset - first + length], 31)
                fields, http, body = parse(raw)
                kind, sha = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response" and digest(body) != sha:
                    raise ValueError(f"record at {offset} of {file} does not match its digest")
                page, other = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                out.append(
                    (
                        None if page is None else int(page),
                        url,
                        int(http["content-length"]),
                        sha,
                        kind,
                        None if other is None else int(other),
                        body if payload and kind == "response" else None,
                    )
                )
            columns = zip(zip(*out, strict=True), kinds, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)
            k = j
    if source is not None:
        source.close()


def read_records(selected: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records of some index rows, with their payloads (NULL for revisits) if asked for."""
    ship(selected.sparkSession)
    rows = selected.select("file", "offset", "length", "url")
    ordered = rows.repartition("file").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(partial(_records, folder=folder, payload=payload), _RECORD)
