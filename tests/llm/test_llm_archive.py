import hashlib

import pytest

from skytally.llm import archive

SCHEMA = "page_id long, url string, html string, sha1 string, size long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


LARGE, ACCENTS = "<p>" + "a" * 1200, "é" * 500


@pytest.fixture
def mixed(spark):
    return pages(
        spark,
        [
            (1, "http://a.example/x y", LARGE),
            (2, None, LARGE),
            (3, "http://c.example/\r\nHeader: bad", LARGE),
            (4, "http://d.example/", ACCENTS),
            (5, "http://e.example/", ACCENTS),
            (6, "http://f.example/", "short"),
            (7, "http://g.example/", "short"),
            (8, "http://h.example/", None),
            (9, "http://i.example/", ""),
            (10, "http://j.example/", "x\r\n\r\nWARC/1.1\r\n\r\n" + "y" * 2000),
            (11, "http://k.example/", "z" * 999),
            (12, "http://l.example/", "z" * 999),
            (None, "http://m.example/", "q" * 1000),
            (13, "http://n.example/", "q" * 1000),
        ],
    )


def test_types_digests_and_references(spark, mixed):
    found = {r.page_id: r for r in archive.archived(mixed).collect()}
    html = {r.page_id: (r.html or "").encode() for r in mixed.collect()}
    for page, row in found.items():
        assert row.payload_bytes == len(html[page])
        assert row.payload_digest == row.stated_digest == hashlib.sha1(html[page]).hexdigest()
        assert row.payload == html[page]
    assert {p: r.refers_to for p, r in found.items() if r.record_type == "revisit"} == {1: 3, 2: 3, 4: 5, None: 13}
    assert all(r.refers_to is None for r in found.values() if r.record_type == "response")


def test_payloads_are_stored_once(spark, mixed, tmp_path):
    archive.write_archive(mixed, str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a/payloads"))
    assert stored.count() == stored.select("content_key").distinct().count() == 7


def test_exported_files_parse_to_the_same_records(spark, mixed, tmp_path):
    records = archive.archived(mixed)
    archive.export_warc(records, str(tmp_path / "w"))
    read = {r.header: r.block for r in archive.read_warc(spark, str(tmp_path / "w")).collect()}
    expected = {r.header: b"" if r.record_type == "revisit" else bytes(r.payload) for r in records.collect()}
    assert {h: bytes(b) for h, b in read.items()} == expected
    assert all("Header: bad" not in h.split("\r\n") for h in read)


def test_altered_payload_is_an_error(spark, tmp_path):
    path = str(tmp_path / "a")
    archive.write_archive(pages(spark, [(1, "http://a.example/", LARGE)]), path)
    key = spark.read.parquet(f"{path}/payloads").first().content_key
    spark.createDataFrame([(key, b"other")], archive.PAYLOADS).write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="does not match"):
        archive.read_archive(spark, path).collect()


def test_repeated_rows_and_empty_table(spark):
    rows = archive.archived(pages(spark, [(1, "u://a/", LARGE), (5, "u://a/", LARGE), (5, "u://a/", LARGE)])).collect()
    assert sorted((r.page_id, r.record_type) for r in rows) == [(1, "revisit"), (5, "response"), (5, "response")]
    assert archive.archived(pages(spark, [])).count() == 0
