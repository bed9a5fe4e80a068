"""Pages that differ in their url alone or not at all, and the form of archives."""

import zlib

from daybook.llm import warc
from daybook.llm.common import scratch_path
from daybook.llm.queries import QUERIES


def test_pages_of_different_urls_keep_their_own_captures(spark):
    rows = [(None, "http://a/", "x"), (None, "http://b/", "x"), (1, "http://c/", "y"), (1, None, "y"), (2, "http://d/", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = warc.warc_roundtrip(pages, scratch_path(spark)).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in found if r.page_id != 2) == [
        ("1", "response", None), ("1", "response", None), ("None", "response", None), ("None", "response", None),
    ]
    assert [(r.record_type, r.refers_to) for r in found if r.page_id == 2] == [("revisit", 1)]


def test_each_repeated_row_is_a_capture(spark):
    rows = [(1, "u", "x")] * 3 + [(2, "u", "x")] * 2 + [(None, None, None)] * 2 + [(0, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = warc.warc_roundtrip(pages, scratch_path(spark)).collect()
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in found)
    assert kinds == sorted(
        [("1", "response", None)] * 3 + [("2", "revisit", 1)] * 2 + [("None", "revisit", 0)] * 2 + [("0", "response", None)]
    )


def test_records_are_members_and_files_are_bounded(spark):
    rows = [(i, f"http://h/{i}", "".join(chr(97 + (i * j * j + j // 7) % 26) for j in range(400 * (1 + i % 3)))) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = scratch_path(spark)
    warc.write_warc(pages, path, chunk_bytes=3000, chunks_per_file=2)
    files = [bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    assert len(files) > 20 and max(map(len, files)) <= 6000
    count = 0
    for content in files:
        while content:
            member = zlib.decompressobj(wbits=31)
            record = member.decompress(content) + member.flush()
            assert member.eof and record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            content = member.unused_data
            count += 1
    assert count == 600


def test_large_records_keep_their_last_byte():
    for size in (0, 1, warc._MEMBER_BYTES - 1, warc._MEMBER_BYTES, 2 * warc._MEMBER_BYTES + 5):
        packed, found = warc.members(b"x" * size), b""
        assert size == 0 or packed.endswith(b"\0")
        while packed:
            member = zlib.decompressobj(wbits=31)
            found += member.decompress(packed) + member.flush()
            packed = member.unused_data
        assert found == b"x" * size


def test_very_long_page(spark):
    html = "<p>é long</p>" * 2_000_000
    pages = spark.createDataFrame([(1, "http://a/", html), (2, "http://b/", html)], "page_id long, url string, html string")
    found = warc.warc_roundtrip(pages, scratch_path(spark)).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in found) == [
        (1, len(html.encode()), "response", None), (2, len(html.encode()), "revisit", 1),
    ]


def test_query_has_a_row_for_each_page(spark):
    sf_dir = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert QUERIES["op9_warc"](spark, sf_dir).count() == pages.count()
