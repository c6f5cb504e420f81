import gzip

import pytest
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch
from tidemark.llm import warc
from tidemark.llm.warc import look_up, parse_record, read_records, url_key, write_archives, write_index


def round_trip(spark, pages, wanted=None):
    scratch = Scratch(spark, "warc-test")
    captures = scratch.table(write_archives(pages, f"{scratch.folder}/warc"))
    parts = write_index(captures, f"{scratch.folder}/index")
    wanted = (wanted if wanted is not None else pages).select("page_id", url_key(F.col("url")).alias("key"))
    return captures, sorted(read_records(look_up(wanted, parts)).collect(), key=str)


def test_url_keys(spark):
    urls = ["http://www.Example.org/A?b=1#top", "https://user@m.x.co.uk:8080", "", None, "no scheme/at all", "http://é.de/ü\t"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(url_key(F.col("url"))).collect()] == ["org,Example)/A?b=1".lower().replace("/a", "/A"), "uk,co,x,m)", "", "", "no scheme)/at all", "de,é)/ü"]


def test_every_page_reads_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    big, exact, small = "é" * 700, "y" * 1000, "z" * 999
    rows = [(i, f"http://h{i % 5}.org/{i % 11}", t) for i, t in enumerate([big, exact, small, "", None, "a\r\n\r\nb"] * 20)]
    rows += [(900, None, big), (901, "http://h1.org/é?x", "p"), (None, "http://h1.org/1", exact), (950, "http://same.org/", "q"), (950, "http://same.org/", "q")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, size int").repartition(3)
    _, got = round_trip(spark, pages)
    response = {t: max(i for i, _, x in rows if x == t and i is not None) for t in (big, exact)}
    want = []
    for i, _, t in rows:
        t = t or ""
        revisit = t in response and i != response[t]
        payload = None if revisit else bytearray(t.encode())
        want.append((i, "revisit" if revisit else "response", payload, len(t.encode()), response[t] if revisit else None))
    assert sorted(((r.page_id, r.record_type, r.payload, r.payload_bytes, r.refers_to) for r in got), key=str) == sorted(want, key=str)


def test_look_ups_read_only_what_they_want(spark):
    pages = spark.createDataFrame([(i, f"http://a.org/{i:05d}", f"page {i}") for i in range(5000)], "page_id long, url string, html string")
    wanted = spark.createDataFrame([(17, "http://a.org/00017"), (17, "http://a.org/00017"), (4999, "http://a.org/04999"), (3, "http://a.org/00004"), (9, "http://b.org/")], "page_id long, url string")
    captures, got = round_trip(spark, pages, wanted)
    assert sorted((r.page_id, bytes(r.payload)) for r in got) == [(17, b"page 17"), (4999, b"page 4999")]
    with pytest.raises(ValueError):
        parse_record(gzip.compress(gzip.decompress(warc._record(1, None, "abc", "0" * 40, 3, False, None))))


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert round_trip(spark, pages)[1] == []


def test_null_and_negative_ids_under_one_key(spark, tmp_path, monkeypatch):
    """Ids that sort around -1 in one block and over several: every record comes back."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    ids = [None, -5, -1, 3, -7, 0, None, -(2**63), 2**63 - 1, -2]
    for n in (5, len(ids)):
        pages = spark.createDataFrame([(i, None, f"page {k}") for k, i in enumerate(ids[:n])], "page_id long, url string, html string").repartition(2)
        folder = str(tmp_path / f"n{n}")
        captures = spark.createDataFrame(warc.write_archives(pages, f"{folder}/warc").collect(), "page_id long, key string, file string, offset long, length long")
        parts = warc.write_index(captures, f"{folder}/index")
        wanted = pages.select("page_id", warc.url_key(pages["url"]).alias("key"))
        got = [(r.page_id, bytes(r.payload).decode()) for r in warc.read_records(warc.look_up(wanted, parts)).collect()]
        assert sorted(got, key=str) == sorted(((i, f"page {k}") for k, i in enumerate(ids[:n])), key=str)
