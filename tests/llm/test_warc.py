import gzip
import io
import urllib.parse

import pytest

from cadenza.llm import warc

LONG = "<p>" + "long payload " * 100 + "</p>"
ROWS = [
    (1, "http://a/1", LONG), (2, "http://a/2", LONG), (9, "http://a/9 x", LONG), (9, "http://a/9 x", LONG), (None, None, LONG),
    (3, "u", "short"), (4, "u", "short"), (5, "http://é/\r\n", None), (6, None, ""), (7, "u", "é\U0001f600" * 70_000), (None, None, None),
    (8, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 40),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, digest string")


def test_records_survive_and_repeats_are_revisits(spark, tmp_path):
    manifest = warc.write(pages(spark, ROWS).repartition(3), str(tmp_path / "archives"))
    got = warc.read(spark, manifest, with_payload=True).collect()
    assert len(got) == len(ROWS) == sum(r["records"] for r in manifest.collect())
    seen = sorted(((r["page_id"], r["url"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got), key=str)
    want = []
    for page, url, html in ROWS:
        revisit = html == LONG and page != 9
        want.append((page, url or "", len((html or "").encode()), "revisit" if revisit else "response", 9 if revisit else None))
    assert seen == sorted(want, key=str)
    by_id = {r["page_id"]: r for r in got if r["record_type"] == "response"}
    assert by_id[7]["payload"].decode() == ROWS[9][2] and by_id[8]["payload"].decode() == ROWS[11][2]


def test_each_record_is_a_gzip_member(spark, tmp_path):
    manifest = warc.write(pages(spark, ROWS), str(tmp_path / "a")).collect()
    for row in manifest:
        data = open(row["path"], "rb").read()
        assert len(data) == row["bytes"]
        assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type: ") == row["records"]


def test_files_roll_over_and_nothing_gives_no_file(spark, tmp_path):
    many = warc.write(pages(spark, ROWS).coalesce(1), str(tmp_path / "b"), file_bytes=1)
    assert many.count() == len(ROWS) and warc.read(spark, many).count() == len(ROWS)
    none = warc.write(pages(spark, ROWS).limit(0), str(tmp_path / "c"))
    assert none.count() == 0 and warc.read(spark, none).count() == 0


def test_damage_is_found():
    whole = warc.record(1, "http://a/", b"payload" * 50, None)
    good = warc._gzipped(whole)
    assert [r["payload"] for r in warc.records(io.BytesIO(good * 2), True)] == [b"payload" * 50] * 2
    spoilt = warc._gzipped(whole.replace(b"payloadpayload\r\n", b"payloadpayloaX\r\n"))
    for bad in (spoilt, good[:-9], warc._gzipped(whole + b"x"), warc._gzipped(whole[:-1])):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(bad)))
    assert urllib.parse.unquote(next(warc.records(io.BytesIO(warc._gzipped(warc.record(1, "a b\r\n", b"", None)))))["url"]) == "a b\r\n"
