import base64
import glob
import hashlib

from tabularium.llm import warc
from tabularium.session import new_path


def test_matches_sql(same_as_sql):
    same_as_sql("op8_warc")


PAGES = [
    (5, "http://a/ b\nc", "<p>same</p>", "x"), (3, None, "<p>same</p>", "x"), (9, "u", None, "x"), (8, "u", "", "x"),
    (7, "u", "été \r\n\r\nWARC/1.1 inside", "x"), (7, "u", "été \r\n\r\nWARC/1.1 inside", "x"), (None, "n", "<p>same</p>", "x"),
    (11, "long", "w " * 200_000, "x"), (None, None, "only here", "x"),
]


def test_types_offsets_and_selected_reads(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, shard string")
    path = new_path(spark, "warc")
    warc.write_archive(pages, path, shard_bytes=1 << 18)
    rows = warc.read_records(spark, path).collect()
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes) for r in rows)
    assert got == sorted([
        ("5", "revisit", "3", 11), ("3", "response", "None", 11), ("9", "revisit", "8", 0), ("8", "response", "None", 0),
        ("7", "response", "None", 25), ("7", "revisit", "7", 25), ("None", "revisit", "3", 11),
        ("11", "response", "None", 400_000), ("None", "response", "None", 9),
    ])
    for r in rows:
        html = next(h or "" for i, _, h, _ in PAGES if i == r.page_id and len((h or "").encode()) == r.payload_bytes)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
    assert {r.url for r in rows} == {"http://a/%20b%0Ac", "about:blank", "u", "n", "long"}
    one = warc.read_records(spark, path, "page_id = 11").collect()
    assert [r.payload_bytes for r in one] == [400_000]
    files = glob.glob(f"{path.removeprefix('file:')}/records/*/*.txt")
    sizes = {f: len(open(f, "rb").read()) for f in files}
    assert sum(sizes.values()) == sum(r.length for r in rows)


def test_small_payloads_may_all_be_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, shard string")
    assert {r.record_type for r in warc.archive(pages, least=100).where("payload_bytes < 100").collect()} == {"response"}


def test_empty_table(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, shard string").limit(0)
    assert warc.archive(pages).count() == 0


def test_ranges_close_together_are_one_read():
    far = 10 * warc.MERGE_GAP
    reads = list(warc.merged([(0, 10), (10, 5), (100, 7), (far, 3)]))
    assert [(a, b, len(c)) for a, b, c in reads] == [(0, 107, 3), (far, far + 3, 1)]
