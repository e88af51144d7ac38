import gzip
import hashlib

from pyspark.sql import functions as F

from tessera.llm import files, warc


def test_query_matches_definition(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    best = {}
    for p in pages:
        best[p.html] = max(best.get(p.html, p.page_id), p.page_id)
    want = {}
    for p in pages:
        b = p.html.encode()
        again = len(b) >= 1000 and best[p.html] != p.page_id
        want[p.page_id] = (len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", best[p.html] if again else None)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.op7_warc(spark, sf).collect()}
    assert got == want


def test_selected_records_revisits_and_nulls(spark, tmp_path):
    long = "é\r\n\r\nx" * 400
    rows = [(1, "http://a/1 2\n", long, 0), (7, "http://a/7", long, 0), (7, "http://a/7b", long, 0), (None, "u", long, 0), (2, None, None, 0), (3, "v", "", 0), (4, "w", "short", 0), (5, "w", "short", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    index = warc.write_warc(pages, f"file://{tmp_path}/w", file_bytes=300)
    got = {(r.page_id, r.url): r for r in warc.read_warc(index).collect()}
    assert {k: (r.record_type, r.refers_to, r.payload_bytes) for k, r in got.items()} == {
        (1, "http://a/1 2\n"): ("revisit", 7, len(long.encode())),
        (7, "http://a/7"): ("response", None, len(long.encode())),
        (7, "http://a/7b"): ("response", None, len(long.encode())),
        (None, "u"): ("revisit", 7, len(long.encode())),
        (2, None): ("response", None, 0),
        (3, "v"): ("response", None, 0),
        (4, "w"): ("response", None, 5),
        (5, "w"): ("response", None, 5),
    }
    assert bytes(got[7, "http://a/7"].payload) == long.encode() and got[1, "http://a/1 2\n"].payload is None
    some = warc.read_warc(index.where("url = 'w'"), gap=0, most=1).collect()
    assert sorted(r.page_id for r in some) == [4, 5]
    # Whole files are valid gzip of WARC records.
    name = index.first().file.removeprefix("file://")
    assert gzip.open(name).read().startswith(b"WARC/1.1\r\nWARC-Type: ")
    assert warc.read_warc(warc.write_warc(pages.where(F.lit(False)), f"file://{tmp_path}/e")).count() == 0


def test_reads_are_coalesced():
    spans = [(0, 10, "a"), (10, 5, "b"), (30, 5, "c"), (1000, 5, "d")]
    assert [(b, e, len(g)) for b, e, g in files.coalesced(spans, 20, 100)] == [(0, 35, 3), (1000, 1005, 1)]
    assert [len(g) for _, _, g in files.coalesced(spans, 20, 12)] == [1, 1, 1, 1]
