"""WARC archives with an index: written by many tasks, read back by byte ranges.

``write`` turns pages into records, each a gzip member of its own (as is usual for
``.warc.gz``), and returns the index: archive, offset, length, type, URL, digest and page.
Of pages with equal payloads the one with the largest id is a ``response``, the others are
``revisit`` records, which name that response and hold no payload.

Each task writes archives of its own under a name that no other attempt uses, and its index
rows become part of the result only if the task succeeds. So the stored index is the commit:
what lost or repeated attempts left behind is in no index, and is never read.

``read`` takes index rows, sorts them by archive and offset, joins neighbours to ranges of a
few megabytes at most, reads each range at once and cuts it into records. Every payload is
hashed again; one that differs from its digest is an error. ``resolve`` gives revisits the
payload figures of the response that they name.

Equal payloads are found by SHA-256 and a group-by that combines in each task; payloads are
shuffled once, for a join that Spark can split, so a payload that a third of all pages have
is spread out. The folder is any that ``pyarrow.fs`` and all workers reach by its URI.

Null payloads count as empty. Ids are numbers or strings. Null ids rank below all others, and pages that repeat the
largest id of their group are all responses. A null URL is left out of its record; carriage
returns and line feeds in URLs are written as ``%0D`` and ``%0A``. Payloads of any length
are held in memory one at a time, ranges grow to the longest record. An empty table gives an
empty index. Other columns play no part.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Callable
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, stored
from tidemark.session import scratch_path

ARCHIVE_BYTES = 256_000_000
GAP_BYTES, RANGE_BYTES = 16_384, 8_000_000
DATE = "1970-01-01T00:00:00Z"  # of records whose page has no time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "archive string, offset long, length long, record_type string, url string, digest string, page_id {id}"
RECORDS = (
    "record_id string, record_type string, url string, page_id {id}, digest string, payload binary, payload_bytes long, "
    "refers_to_id string"
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: object, digest: str) -> str:
    """The same for the same page and payload, so a revisit can name its response."""
    return uuid.UUID(bytes=hashlib.md5(f"{page}\n{digest}".encode()).digest()).urn


def http_head(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as a gzip member; fields that are None are left out."""
    lines = [f"{name}: {value}" for name, value in [*fields, ("Content-Length", len(block))] if value is not None]
    data = "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"
    return gzip.compress(data, 1, mtime=0)


def page_record(page: object, url: str | None, payload: bytes, digest: str, response: object, revisit: bool) -> bytes:
    kind = "revisit" if revisit else "response"
    target = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id(page, digest) if not revisit else uuid.uuid4().urn}>"),
        ("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", f"<{record_id(response, digest)}>" if revisit else None),
        ("Content-Type", "application/http;msgtype=response"), ("X-Page-Id", None if page is None else json.dumps(page)),
    ]
    return record(fields, http_head(len(payload)) + (b"" if revisit else payload))


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"the record {fields.get('WARC-Record-ID')} has another length than it says")
    return fields, rest[:size]


def _write(folder: str, archive_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder)
        out = name = None
        for batch in batches:
            index: list[tuple] = []
            for values in zip(*map(batch.column, ("page_id", "url", "payload", "response", "revisit"))):
                page, url, content, response, revisit = (v.as_py() for v in values)
                payload = content if isinstance(content, bytes) else (content or "").encode()
                digest = sha1_base32(payload)
                if out is not None and out.tell() >= archive_bytes:
                    out.close()
                    out = None
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                    info = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
                    out.write(record([
                        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", DATE),
                        ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
                    ], info))
                data = page_record(page, url, payload, digest, response, revisit)
                index.append((name, out.tell(), len(data), "revisit" if revisit else "response", url, digest))
                out.write(data)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            columns = [pa.array([i[k] for i in index], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column("page_id")], ["archive", "offset", "length", "record_type", "url", "digest", "page_id"]
            )
        if out is not None:
            out.close()

    return run


def write(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write ``pages`` (payload text or binary) to archives in ``folder``; the stored index.

    Payloads of under ``least_bytes`` bytes are responses all.
    """
    payload = column(pages, payload_col)
    rows = pages.select(
        column(pages, id_col).alias("page_id"), column(pages, url_col).alias("url"), payload.alias("payload"),
        F.coalesce(payload.cast("binary"), F.lit(b"")).alias("data"),
    )
    rows = rows.select("page_id", "url", "payload", F.sha2("data", 256).alias("sha"), F.octet_length("data").alias("size"))
    # The second key repeats the first: both sides are shuffled for the join, and hot parts can be split.
    groups = rows.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("response"), F.min("sha").alias("again"))
    groups = groups.where("n > 1").select(F.col("sha").alias("of"), "again", "response")
    joined = rows.join(groups, (F.col("sha") == F.col("of")) & (F.col("sha") == F.col("again")), "left")
    differs = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    dealt = joined.select("page_id", "url", "payload", "response", (differs & (F.col("size") >= least_bytes)).alias("revisit"))
    kind = rows.schema["page_id"].dataType.simpleString()
    _make(folder)
    return stored(dealt.mapInArrow(_write(folder, archive_bytes), INDEX.format(id=kind)), "warc-index")


def _make(folder: str) -> None:
    from pyarrow import fs

    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root)


def _ranges(places: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Stretches of sorted (archive, offset, length) that are read at once."""
    start = 0
    for i in range(1, len(places) + 1):
        if i < len(places):
            (last, at, size), (archive, offset, length) = places[i - 1], places[i]
            near = archive == last and 0 <= offset - at - size <= GAP_BYTES
            if near and offset + length - places[start][1] <= RANGE_BYTES:
                continue
        yield start, i
        start = i


def _read(folder: str, id_type: pa.DataType, payloads: bool) -> Callable:
    def rows(places: list[tuple[str, int, int]]) -> Iterator[tuple]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder)
        name = source = None
        for start, end in _ranges(places):
            archive, first, _ = places[start]
            if archive != name:
                if source is not None:
                    source.close()
                name, source = archive, files.open_input_file(f"{root}/{archive}")
            source.seek(first)
            data = source.read(places[end - 1][1] + places[end - 1][2] - first)
            for _, offset, length in places[start:end]:
                fields, block = parsed(zlib.decompress(data[offset - first : offset - first + length], 31))
                digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                if payload is not None and sha1_base32(payload) != digest:
                    raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not the one its digest names")
                refers, page = fields.get("WARC-Refers-To"), json.loads(fields.get("X-Page-Id", "null"))
                yield (
                    fields["WARC-Record-ID"][1:-1], kind, fields.get("WARC-Target-URI"), page, digest,
                    payload if payloads else None, None if payload is None else len(payload), refers and refers[1:-1],
                )
        if source is not None:
            source.close()

    def batch(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.string(), id_type, pa.string(), pa.binary(), pa.int64(), pa.string()]
        columns = [pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)]
        names = ["record_id", "record_type", "url", "page_id", "digest", "payload", "payload_bytes", "refers_to_id"]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            places = list(zip(*(part.column(c).to_pylist() for c in ("archive", "offset", "length"))))
            found, held = [], 0
            for row in rows(places):
                found.append(row)
                held += len(row[5] or b"")
                if held > RANGE_BYTES:
                    yield batch(found)
                    found, held = [], 0
            yield batch(found)

    return run


def read(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that ``index`` selects; payloads are hashed, and returned if asked for.

    Revisits have no payload and no ``payload_bytes``; ``refers_to_id`` names their response.
    """
    kind = index.schema["page_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    places = index.select("archive", "offset", "length").repartitionByRange("archive", "offset")
    return places.sortWithinPartitions("archive", "offset").mapInArrow(
        _read(folder, to_arrow_type(kind), payloads), RECORDS.format(id=kind.simpleString())
    )


def resolve(records: DataFrame) -> DataFrame:
    """``records`` with ``payload_bytes`` for revisits too, and ``refers_to``, the response's page.

    ``records`` is read twice, so store it first.
    """
    originals = records.where("record_type = 'response'").groupBy("record_id").agg(
        F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("full"), F.min("record_id").alias("again")
    ).withColumnRenamed("record_id", "of")
    revisit = F.col("record_type") == "revisit"
    named = F.when(revisit, F.col("refers_to_id"))
    joined = records.join(originals, (named == F.col("of")) & (named == F.col("again")), "left")
    return joined.select(
        *[c for c in records.columns if c != "payload_bytes"],
        F.coalesce("payload_bytes", "full").alias("payload_bytes"), "refers_to",
    )


def archive_folder(spark) -> str:
    """A fresh folder for archives below the shared one, as a URI."""
    return scratch_path(spark, "warc")
