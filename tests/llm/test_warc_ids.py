"""Ids of any text come back from the archives."""

from tests.llm import brute
from tidemark.llm import warc
from tidemark.sources.scratch import scratch_path

IDS = ["null", "", None, "a\nb", "a%0Ab", "a\r\n\r\nWARC-Type: x", "<urn:x>", "é日😀", " ", "a>b<", "no-page", "\x00", "%", " "]


def test_string_ids(spark):
    rows = [(x, "http://h/" + (x or ""), f"<p>{k % 5}</p>") for k, x in enumerate(IDS)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = [r.asDict() for r in warc.round_trip(pages, scratch_path(spark, "warc")).collect()]
    key = lambda r: str(sorted(r.items(), key=str))
    assert sorted(got, key=key) == sorted(brute.warc([(p, h) for p, _, h in rows]), key=key)


def test_names_are_reversible():
    for x in IDS:
        assert warc.page_of(warc.name_of(x)) == x
        head = warc.record(x, "u", b"payload", None)
        assert warc.parse_record(head)["id"] == x and head.count(b"WARC-Type:") == 1


def test_many_records_of_a_range_are_cut_by_the_index(spark):
    pages = spark.createDataFrame([(i, "u", f"<p>{i}</p>") for i in range(3000)], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.roles(pages.coalesce(1)), scratch_path(spark, "warc"))
    assert sorted(int(r["id"]) for r in warc.read_archives(manifest, range_bytes=1 << 30).collect()) == list(range(3000))


def test_a_payload_of_a_third_of_the_pages(spark):
    rows = [(i, "u", "hot" if i % 3 == 0 else f"page {i}") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["refers_to"] for r in warc.roles(pages).collect()}
    assert got == {i: 0 if i % 3 == 0 and i else None for i, _, _ in rows}
