import gzip
import hashlib
import pathlib

from capplan.llm import warc

SCHEMA = "page_id long, url string, html string"


def test_archives_are_read_back(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>{i % 30} é</p>\r\n\r\nWARC/1.1\r\n") for i in range(100)]
    rows += [(200, None, None), (201, "http://h/a b\n", ""), (202, "u", "x" * 300_000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    index, folder = warc.write_archives(frame, f"{tmp_path}/w", archive=2000)
    found = {r.page_id: r for r in warc.read_records(index, folder).collect()}
    assert len(found) == len(rows) and index.select("file").distinct().count() > 4
    last = {(html or ""): page for page, _, html in rows}
    for page, url, html in rows:
        raw, row = (html or "").encode(), found[page]
        other = last[html or ""]
        assert (row.url, row.payload_bytes) == (url, len(raw))
        assert row.payload_digest == warc.digest(raw)
        assert (row.record_type, row.refers_to) == (("response", None) if other == page else ("revisit", other))
        assert row.payload == (raw if other == page else None)
    # a few records by their ranges alone
    some = warc.read_records(index.where("page_id in (5, 202)"), folder).collect()
    assert {r.page_id for r in some} == {5, 202}


def test_archives_are_plain_gzip_members(spark, tmp_path):
    frame = spark.createDataFrame([(1, "http://h/1", "one"), (2, "http://h/2", "two")], SCHEMA).coalesce(1)
    index, folder = warc.write_archives(frame, f"{tmp_path}/w")
    path = pathlib.Path(folder.removeprefix("file://"))
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in sorted(path.glob("*.warc.gz")))
    assert whole.count(b"WARC/1.1\r\nWARC-Type: response\r\n") == 2
    row = index.where("page_id = 2").first()
    member = (path / row.file).read_bytes()[row.offset : row.offset + row.length]
    fields, _, payload = warc.parse(gzip.decompress(member))
    assert payload == b"two" and fields["warc-target-uri"] == "http://h/2"
    assert warc.digest(b"two") == "".join(warc.base64.b32encode(hashlib.sha1(b"two").digest()).decode())


def test_odd_input(spark, tmp_path):
    rows = [(1, "u", "same"), (1, "u", "same"), (None, "u", "same"), (None, None, "alone"), (None, None, "alone")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS file", "1 AS response", "2 AS sha")
    index, folder = warc.write_archives(frame, f"{tmp_path}/w")
    found = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.read_records(index, folder).collect()), key=str)
    assert found == sorted([(1, "response", None), (1, "response", None), (None, "revisit", 1), (None, "response", None), (None, "response", None)], key=str)
    index, folder = warc.write_archives(frame.limit(0), f"{tmp_path}/none")
    assert warc.read_records(index, folder).count() == 0
