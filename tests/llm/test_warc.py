"""Archives: what is written comes back by index, whole and checked."""

import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.session import scratch_path

ROWS = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>two</p>"), (3, "http://c/\r\nX: y", "<p>one</p>"), (9, None, "<p>one</p>"),
    (4, "http://d/é", None), (5, "http://e/", ""), (6, "http://f/", "é\r\n\r\nWARC/1.1\r\n" * 3), (None, "http://g/", "<p>two</p>"),
    (7, "http://h/", "x" * 3_000_000), (8, "", "only"), (8, "http://i/", "only"),
]


def written(spark, rows, **options):
    folder = scratch_path(spark, "warc")
    pages = spark.createDataFrame([(*r, 0, "z") for r in rows], "page_id long, url string, html string, offset int, digest string")
    return folder, warc.write(pages.repartition(3), folder, **options)


def plain(rows, least=0):
    best = {}
    for page, _, html in rows:
        best[html or ""] = max(best.get(html or ""), page, key=lambda p: -1 if p is None else p)
    out = []
    for page, _, html in rows:
        data, response = (html or "").encode(), best[html or ""]
        revisit = page != response and len(data) >= least
        out.append((page, len(data), warc.sha1_base32(data), "revisit" if revisit else "response", response if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 8])
def test_pages_come_back(spark, least):
    folder, index = written(spark, ROWS, least_bytes=least)
    records = warc.read(index, folder)
    found = warc.resolve(records)
    got = [(r.page_id, r.payload_bytes, r.digest, r.record_type, r.refers_to) for r in found.collect()]
    assert sorted(got, key=repr) == plain(ROWS, least)
    texts = {r.page_id: bytes(r.payload).decode() for r in records.where("record_type = 'response'").collect()}
    whole = {p: h or "" for p, _, h in ROWS}
    assert all(texts[p] == whole[p] for p in texts)
    urls = {r.page_id: r.url for r in records.collect() if r.page_id not in (8,)}
    assert urls[9] is None and urls[3] == "http://c/%0D%0AX: y" and urls[4] == "http://d/é"


def test_index_places_records(spark):
    """Offset and length cut out one gzip member; all members in a row are the archive."""
    folder, index = written(spark, ROWS, archive_bytes=200)
    rows = index.collect()
    root = folder.removeprefix("file:")
    assert len({r.archive for r in rows}) > 3
    for r in rows:
        with open(f"{root}/{r.archive}", "rb") as source:
            data = source.read()
        fields, block = warc.parsed(gzip.decompress(data[r.offset : r.offset + r.length]))
        assert fields["WARC-Type"] == r.record_type and fields["WARC-Payload-Digest"] == f"sha1:{r.digest}"
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        if r.record_type == "revisit":
            assert block.endswith(b"\r\n\r\n") and fields["WARC-Profile"] == warc.PROFILE
    responses = {f"<{warc.record_id(r.page_id, r.digest)}>" for r in rows if r.record_type == "response"}
    records = warc.read(index, folder, payloads=False)
    assert {f"<{r.refers_to_id}>" for r in records.where("record_type = 'revisit'").collect()} <= responses


def test_selected_records_only(spark):
    folder, index = written(spark, ROWS)
    some = warc.read(index.where("page_id IN (2, 6)"), folder)
    assert sorted(r.page_id for r in some.collect()) == [2, 6]


def test_neighbours_are_read_at_once():
    places = [("a", 0, 10), ("a", 10, 5), ("a", 20, 5), ("a", 50_000, 5), ("b", 0, 7), ("b", 7, warc.RANGE_BYTES), ("b", warc.RANGE_BYTES + 7, 1)]
    assert list(warc._ranges(places)) == [(0, 3), (3, 4), (4, 5), (5, 6), (6, 7)]
    assert list(warc._ranges([])) == []


def test_a_changed_payload_is_an_error(spark):
    folder, index = written(spark, [(1, "u", "some payload")])
    place = index.first()
    path = f"{folder.removeprefix('file:')}/{place.archive}"
    with open(path, "rb") as source:
        data = source.read()
    record = gzip.decompress(data[place.offset : place.offset + place.length]).replace(b"some payload", b"same payload")
    with open(path, "wb") as target:
        target.write(data[: place.offset] + gzip.compress(record, 1, mtime=0))
    changed = index.withColumn("length", F.lit(os.path.getsize(path) - place.offset).cast("long"))
    with pytest.raises(Exception, match="not the one its digest names"):
        warc.read(changed, folder).collect()


def test_archives_of_lost_attempts_are_not_read(spark):
    folder, index = written(spark, ROWS)
    with open(f"{folder.removeprefix('file:')}/left-behind.warc.gz", "wb") as target:
        target.write(b"half a record")
    assert warc.read(index, folder).count() == len(ROWS)


def test_empty_and_binary(spark):
    folder, index = written(spark, [])
    assert index.count() == 0 and warc.resolve(warc.read(index, folder)).count() == 0
    folder = scratch_path(spark, "warc")
    pages = spark.createDataFrame([("a", "u", b"\xff\x00\r\n\r\n"), ("b", "u", b"\xff\x00\r\n\r\n"), ("c", "u", None)], "page_id string, url string, html binary")
    found = {r.page_id: r for r in warc.resolve(warc.read(warc.write(pages, folder), folder)).collect()}
    assert bytes(found["b"].payload) == b"\xff\x00\r\n\r\n" and found["a"].refers_to == "b" and found["a"].payload_bytes == 6
    assert found["c"].digest == warc.sha1_base32(b"") and hashlib.sha1(b"").hexdigest()


def test_a_hot_payload(spark):
    rows = [(i, f"http://x/{i}", "same" if i % 3 else f"page {i}") for i in range(600)]
    folder, index = written(spark, rows)
    found = warc.resolve(warc.read(index, folder)).collect()
    assert sum(r.refers_to == 599 for r in found) == 399 and len(found) == 600
