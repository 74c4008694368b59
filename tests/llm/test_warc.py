import hashlib
import io

import pytest
import zstandard
from authweave.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, size int, latest long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA)


def test_round_trip(spark, tmp_path):
    long = "é<p>text</p>" * 200
    rows = [(1, "http://a/1", long), (2, "http://a/2", long), (3, None, "short"), (4, "http://a\r\nX: y", "short"),
            (5, "u", None), (6, "u", ""), (7, "u", "z" * 3_000_000), (None, "u", long), (2, "again", long)]
    records = warc.plan_records(pages(spark, rows))
    read = warc.read_archives(warc.write_archives(records, f"file://{tmp_path}/w")).collect()
    assert len(read) == len(rows)
    found = {(r.page_id, r.url): r for r in read}
    for page, url, html in rows:
        row = found[page, url.replace("\r", "%0D").replace("\n", "%0A") if url else None]
        body = (html or "").encode()
        assert (row.payload_bytes, row.payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
        revisit = html == long and page != 2
        assert row.record_type == ("revisit" if revisit else "response")
        assert row.refers_to == (2 if revisit else None)
        assert row.payload == (None if revisit else body)


def test_archives_lead_with_a_dictionary_and_are_smaller_for_it():
    records = [warc._record(k, f"http://h/{k}", bytes(20), 9, b"<html><body class='x'>%d</body></html>" % k, None)
               for k in range(500)]
    data = warc.archive_bytes(records)
    assert data[:4] == warc.SKIPPABLE
    plain = sum(len(zstandard.ZstdCompressor().compress(r)) for r in records)
    assert len(data) < plain
    assert len(list(warc.read_archive(io.BytesIO(data)))) == 500
    one = warc.archive_bytes(records[:1])
    assert one[:4] != warc.SKIPPABLE and len(list(warc.read_archive(io.BytesIO(one)))) == 1


def test_damage_is_noticed():
    data = warc.archive_bytes([warc._record(1, "u", bytes(20), 3, b"abc", None)])
    with pytest.raises(EOFError):
        list(warc.read_archive(io.BytesIO(data[:-3])))


def test_empty_table(spark, tmp_path):
    assert warc.archive_pages(pages(spark, []), f"file://{tmp_path}/e").count() == 0


def test_rows_without_ids_only(spark, tmp_path):
    read = warc.archive_pages(pages(spark, [(None, "a", "x" * 2000), (None, "b", "x" * 2000)]), f"file://{tmp_path}/n")
    assert [(r.page_id, r.record_type, r.refers_to) for r in read.collect()] == [(None, "response", None)] * 2
