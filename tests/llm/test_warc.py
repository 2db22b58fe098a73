"""WARC: round trip of payloads, revisits, index lookups, whole files as gzip."""

from __future__ import annotations

import glob
import gzip
import hashlib

import pytest
from tests_paths import SF001

from strandline.llm import warc as w

PAGES = "page_id long, url string, html string"
ODD = [
    (1, "http://a.example.com/x?y#z", "<p>" + "é" * 80),
    (2, "http://b.example.com/", "<p>" + "é" * 80),
    (3, "http://b.example.com/", "short"), (4, None, "short"), (5, "https://user@c.example.org:8080/p q\r\nX: y", None),
    (6, "not a url", ""), (7, "http://a.example.com/x?y", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 30),
    (8, "http://a.example.com/big", "z" * 2_000_000), (9, "http://a.example.com/x?y#z", "<p>" + "é" * 80),
    (None, "http://n.example.com/", "n" * 200), (10, "http://n.example.com/", "n" * 200),
]


def _read_back(spark, tmp_dir, df, files=3, monkey=None):
    w.ship(spark)
    captures = w.write_archives(df, f"{tmp_dir}/warc")
    top = w.write_index(captures, f"{tmp_dir}/index", files)
    keys = df.select(w.capture_key(df["url"], df["page_id"]).alias("key"))
    return w.lookup(keys, top, f"{tmp_dir}/index", f"{tmp_dir}/warc").collect()


def test_payloads_come_back(spark, tmp_dir):
    df = spark.createDataFrame(ODD, PAGES)
    rows = {r["page_id"]: r for r in _read_back(spark, tmp_dir, df)}
    assert set(rows) == {r[0] for r in ODD}
    for page, _, html in ODD:
        data, r = (html or "").encode(), rows[page]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        want = {2: 1, 9: 1, None: 10}.get(page)
        assert (r["record_type"], r["refers_to"]) == (("revisit", want) if want else ("response", None))
        assert bytes(r["payload"]) == (b"" if want else data)


def test_archives_are_gzip_members(spark, tmp_dir):
    _read_back(spark, tmp_dir, spark.createDataFrame(ODD, PAGES).coalesce(1))
    files = glob.glob(f"{tmp_dir}/warc/*.warc.gz")
    data = b"".join(gzip.decompress(open(f, "rb").read()) for f in files)
    assert data.count(b"WARC-Type: ") == len(ODD) and data.startswith(b"WARC/1.1\r\n")
    assert b"\r\nX: y" not in data  # a url cannot add a header line


@pytest.mark.parametrize("block", [1, 2, 1000])
def test_blocks_and_equal_keys(spark, tmp_dir, monkeypatch, block):
    rows = [(i // 3, f"http://h{i % 4}.example.com/{i // 60}", f"page {i}" * 20) for i in range(300)]
    df = spark.createDataFrame(rows, PAGES).repartition(4)
    got = _read_back(spark, tmp_dir, df, files=5)
    assert sorted(r["payload_digest"] for r in got) == sorted(hashlib.sha256(h.encode()).hexdigest() for _, _, h in rows)


def test_lookup_of_some_keys(spark, tmp_dir):
    rows = [(i, f"http://h{i % 7}.example.com/{i}", f"<p>{i}") for i in range(200)]
    df = spark.createDataFrame(rows, PAGES)
    w.ship(spark)
    top = w.write_index(w.write_archives(df, f"{tmp_dir}/w"), f"{tmp_dir}/i", 4)
    some = df.where("page_id % 50 = 3")
    keys = some.select(w.capture_key(some["url"], some["page_id"]).alias("key")).union(spark.createDataFrame([("zz,nothing)/ 1",), ("",)], "key string"))
    assert sorted(r["page_id"] for r in w.lookup(keys, top, f"{tmp_dir}/i", f"{tmp_dir}/w").collect()) == [3, 53, 103, 153]


def test_url_keys(spark):
    df = spark.createDataFrame([("http://WWW.Example.com:80/A?b#c",), ("https://u:p@x.org",), (None,), ("a b",)], "url string")
    assert [r[0] for r in df.select(w.url_key(df["url"])).collect()] == ["com:80,example,www)/A?b", "org,x)", ")", ")a%20b"]


def test_query_and_empty(spark, tmp_path):
    import __spark_entry__ as se
    from oracle import compare, duck

    ok, why = compare(se.queries()["op3_warc"](spark, SF001), duck(SF001), se.oracle_sql()["op3_warc"])
    assert ok, why
    spark.createDataFrame([], PAGES + ", key string, digest string, first string").write.parquet(f"{tmp_path}/pages.parquet")
    assert w.op3_warc(spark, str(tmp_path)).count() == 0
    more = spark.createDataFrame([(1, "u", "h" * 200, "k", "d", 5), (1, "u", "h" * 200, "k", "d", 5)], PAGES + ", key string, digest string, first int")
    more.write.parquet(f"{tmp_path}/more/pages.parquet")
    assert [(r["page_id"], r["record_type"]) for r in w.op3_warc(spark, f"{tmp_path}/more").collect()] == [(1, "response")] * 2
