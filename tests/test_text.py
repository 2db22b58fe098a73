"""Tokeniser edges, dump loader edges and round trip, word count plan and output order."""

from __future__ import annotations

import os

import pytest
from input_folders import SF001
from pyspark.sql import Row
from pyspark.sql import functions as F

from strandline.functions.text import extract_title, tokenize, xml_escape
from strandline.plans import text
from strandline.sources.xmldump import render_page, scan_fragments, write_dump


def _tokens(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "text string")
    return [r.t for r in df.select(tokenize("text").alias("t")).collect()]


def test_tokenize_java_split_rules(spark):
    got = _tokens(spark, ["", "   ", "  a b  ", "a\tb\n", "a\u00a0b", None, "x", " y", "z "])
    assert got == [[""], [], ["", "a", "b"], ["a", "b"], ["a\u00a0b"], None, ["x"], ["", "y"], ["z"]]


def test_tokenize_null_gives_no_rows(spark):
    df = spark.createDataFrame([(None,), ("a a",)], "text string")
    assert sorted(tuple(r) for r in text.count_words(df).collect()) == [("a", 2)]


def test_word_count_plan_has_one_exchange_and_partial_aggregate(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("text")
    plan = text.count_words(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(word") == 1 and plan.count("Exchange") == 1
    assert "partial_count" in plan


def test_word_count_reads_only_text_in_one_exchange(spark):
    plan = text.word_count(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan and plan.count("Exchange") == 1


def test_spread_is_the_callers_setting(spark):
    from strandline.sources.tables import PARTITIONS, spread

    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("text")
    assert spread(docs) is docs
    spark.conf.set(PARTITIONS, "6")
    try:
        assert "RoundRobinPartitioning(6)" in spread(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(PARTITIONS)


def test_load_dump_scans_once(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "d.xml"), "w") as fh:
        fh.write("<page><title>A</title><text>x</text></page>")
    for df in (text.load_dump(spark, tmp_dir), text.load_dump(spark, tmp_dir).where("reason IS NULL")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan text") == 1 and "Exchange" not in plan


def test_split_write_does_not_sort(spark, tmp_dir):
    from strandline.operators.quarantine import concurrent_writers, write_split

    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "bad").alias("reason"))
    with concurrent_writers(spark):
        plan = (df.withColumn("outcome", F.coalesce("reason", F.lit("valid"))))
        plan.createOrReplaceTempView("split_rows")
        spark.sql("CREATE OR REPLACE TEMPORARY VIEW split_view AS SELECT * FROM split_rows")
        spark.sql(f"CREATE TABLE split_target (id BIGINT, reason STRING, outcome STRING) USING parquet PARTITIONED BY (outcome) LOCATION '{tmp_dir}/t'")
        try:
            shown = spark.sql("EXPLAIN INSERT OVERWRITE split_target SELECT id, reason, outcome FROM split_view").first()[0]
        finally:
            spark.sql("DROP TABLE split_target")
    assert "Sort [" not in shown
    write_split(df, f"{tmp_dir}/o")
    assert {r["outcome"]: r["count"] for r in spark.read.parquet(f"{tmp_dir}/o").groupBy("outcome").count().collect()} == {"bad": 334, "valid": 666}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


@pytest.mark.parametrize("html,title", [
    ("<title>A</title>", "A"), ("<TITLE>A</TITLE>", "A"), ('<title lang="en">A</title>', "A"), ("<title\nid=x>A\nB</title >", "A\nB"),
    ("<title></title>", ""), ("<p>none</p>", None), ("<titles>x</titles>", None), ("<title>open", None), (None, None),
    ("<title>a&#39;b</title>", "a'b"), ("<title>&#x1F642;&#233;</title>", "🙂é"), ("<title>&amp;lt; &amp;#39; &#38;lt;</title>", "&lt; &#39; &lt;"),
    ("<title>&lt;b&gt; &quot;&apos;</title>", "<b> \"'"), ("<title>&#0;&#xD800;&#99999999;</title>", "\ufffd\ufffd\ufffd"), ("<title>A & B &c;</title>", "A & B &c;"),
    ("<title>1</title><title>2</title>", "1"),
])
def test_title_of_real_markup(spark, html, title):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(extract_title("html").alias("t")).first().t == title


def test_word_count_tsv_sorted_within_files(spark, tmp_dir):
    from strandline.operators.ordering import key_partitioned_sorted
    from strandline.sources.articles import write_tsv

    counts = key_partitioned_sorted(text.word_count(spark, SF001), "word", 3)
    write_tsv(counts, tmp_dir, "word", "n")
    files = [f for f in os.listdir(tmp_dir) if f.startswith("part-")]
    assert files
    total = 0
    for f in files:
        with open(os.path.join(tmp_dir, f), encoding="utf-8") as fh:
            words = [line.rstrip("\n").split("\t")[0] for line in fh]
        total += len(words)
        assert [w.encode() for w in words] == sorted(w.encode() for w in words)
    assert total == text.word_count(spark, SF001).count()


def _load_strings(spark, tmp_dir, body, name="d"):
    path = os.path.join(tmp_dir, name)
    os.makedirs(path)
    with open(os.path.join(path, "dump.xml"), "w", encoding="utf-8") as fh:
        fh.write(body)
    rows = text.load_dump(spark, path).collect()
    return sorted(((r.title, r.text, r.reason) for r in rows), key=repr)


def test_dump_edge_cases(spark, tmp_dir):
    body = (
        "<mediawiki>\n"
        "<page><title>T1</title><title>T1b</title><revision><text>x1</text></revision>"
        "<revision><text>x1b</text></revision></page>\n"
        "<page><revision><text>no title</text></revision></page>\n"
        "<page><title>bad<revision><text>y</text></revision></page>\n"
        "<page><title>T4</title><revision><text>after bad</text></revision></page>\n"
        "<page><title>cut</title><revision><text>never closed</text></revision>\n"
        "<page><title>T6</title><revision><text>after unclosed</text></revision></page>\n"
        "<page><title>T7&foo;</title><text>e</text></page>\n"
        "<page><title a='1' a='2'>T8</title><text>e</text></page>\n"
        "<page><title>T9 & bare</title><text>e</text></page>\n"
        "<page> <title xml:space='preserve'> T10 </title><revision><text><![CDATA[a<b]]></text>"
        "</revision></page>\n"
        "<page><title>T11</title><revision><text>a<b>c</b>d</text></revision></page>\n"
        "<page><title>T12</title></page>\n"
        "<page><title>T13</title><text>x</text></page ><junk/></page>\n"
        "</mediawiki>\n"
    )
    got = _load_strings(spark, tmp_dir, body)
    good = [(t, x) for t, x, r in got if r is None]
    assert sorted(good) == sorted([("T1", "x1"), ("T4", "after bad"), ("T6", "after unclosed"),
                                   (" T10 ", "a<b"), ("T11", "acd")])
    reasons = sorted(r for _, _, r in got if r is not None)
    assert reasons == sorted(["no_title", "bad_xml", "unclosed_page", "bad_xml", "bad_xml", "bad_xml",
                              "no_text", "bad_xml"])


def test_loader_job_keeps_quarantine_and_counts_both(spark, tmp_dir):
    from strandline.sources.articles import read_articles

    dump = os.path.join(tmp_dir, "d")
    os.makedirs(dump)
    with open(os.path.join(dump, "x.xml"), "w") as fh:
        fh.write("<page><title>A</title><text>a b</text></page>\n<page><title>B<text>x</text></page>\n"
                 "<page><text>no title</text></page>\n")
    out = os.path.join(tmp_dir, "out")
    assert text.dump_load_to_table(spark, dump, out) == 1
    assert sorted(d for d in os.listdir(out) if d.startswith("outcome=")) == [
        "outcome=bad_xml", "outcome=no_title", "outcome=valid"]
    assert [tuple(r) for r in read_articles(spark, out).collect()] == [("A", "a b")]
    bad = spark.read.parquet(out).where("outcome != 'valid'").collect()
    assert all(r.fragment.startswith("<page>") for r in bad)


def test_dump_without_root_gives_same_rows(spark, tmp_dir):
    pages = "<page><title>A</title><revision><text>1</text></revision></page>\n" * 2
    with_root = _load_strings(spark, tmp_dir, "<mediawiki>\n" + pages + "</mediawiki>\n", "a")
    without = _load_strings(spark, tmp_dir, pages, "b")
    assert with_root == without == [("A", "1", None), ("A", "1", None)]


def test_dump_round_trip_and_article_table(spark, tmp_dir):
    src = spark.createDataFrame(
        [Row(title="a & <b>", text="line1\n  x > y  \n"), Row(title="t2", text=""),
         Row(title="t3", text="é ü 字 \t")], "title string, text string")
    dump = os.path.join(tmp_dir, "dump")
    write_dump(src.select(render_page(F.col("title"), F.col("text")).alias("page")).repartition(2), dump)
    out = os.path.join(tmp_dir, "articles")
    n = text.dump_load_to_table(spark, dump, out)
    assert n == 3
    back = text.word_count_articles(spark, out)
    assert back.count() > 0
    from strandline.sources.articles import read_articles

    got = sorted(tuple(r) for r in read_articles(spark, out).collect())
    assert got == sorted(tuple(r) for r in src.collect())


def test_scan_is_map_only(spark, tmp_dir):
    path = text.render_documents_dump(spark, SF001)
    plan = text.load_dump(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_scan_fragments_begin_tag_is_exact(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x")
    os.makedirs(path)
    with open(os.path.join(path, "f.xml"), "w") as fh:
        fh.write('<page id="1"><title>no</title></page>\n<page><title>yes</title><text>t</text></page>\n')
    frags = [r.fragment for r in scan_fragments(spark, path).collect()]
    assert frags == ["<page><title>yes</title><text>t</text></page>"]


def test_null_fragment_is_bad_xml(spark):
    frags = spark.createDataFrame([(None, None)], "fragment string, unclosed_head string")
    r = text.parse_pages(frags).first()
    assert r.reason == "bad_xml" and r.title is None


def test_xml_escape_and_title(spark):
    df = spark.createDataFrame([("<a&b>", "<html><title>x &amp; y</title><title>z</title>")], "s string, h string")
    r = df.select(xml_escape("s").alias("e"), extract_title("h").alias("t"),
                  extract_title("h", decode=False).alias("raw")).first()
    assert (r.e, r.t, r.raw) == ("&lt;a&amp;b&gt;", "x & y", "x &amp; y")


def test_cli_dump_load_then_word_count(spark, tmp_dir):
    from strandline.cli import main

    dump = text.render_documents_dump(spark, SF001)
    arts, tsv = os.path.join(tmp_dir, "arts"), os.path.join(tmp_dir, "tsv")
    assert main(["dump-load", dump, arts]) == 0
    assert main(["word-count", arts, tsv, "--partitions", "3"]) == 0
    lines = spark.read.text(tsv)
    assert lines.count() == text.word_count(spark, SF001).count()


def test_dump_scan_correct_across_many_small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    path = text.render_documents_dump(spark, SF001)
    try:
        spark.conf.set(key, str(16 * 1024))  # pages straddle split boundaries
        frags = scan_fragments(spark, path)
        assert frags.rdd.getNumPartitions() > 8
        got = sorted(tuple(r) for r in text.articles(text.load_dump(spark, path)).collect())
    finally:
        spark.conf.set(key, old)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = sorted(tuple(r) for r in docs.select(
        F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("title"), "text").collect())
    assert got == want


def test_bzip2_dump_is_split_and_loads_whole(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    pages = docs.select(render_page(F.concat_ws("-", "source", F.col("doc_id").cast("string")),
                                    F.col("text")).alias("page"))
    path = os.path.join(tmp_dir, "bz2")
    pages.coalesce(1).write.option("compression", "bzip2").text(path)
    assert any(f.endswith(".bz2") for f in os.listdir(path))
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, str(32 * 1024))
        assert scan_fragments(spark, path).rdd.getNumPartitions() > 1
        got = sorted(tuple(r) for r in text.articles(text.load_dump(spark, path)).collect())
    finally:
        spark.conf.set(key, old)
    want = sorted(tuple(r) for r in docs.select(
        F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("title"), "text").collect())
    assert got == want


def test_tokenize_java_whitespace_class(spark):
    # Java's \s: space, tab, newline, vertical tab, form feed, carriage return; not NBSP
    got = _tokens(spark, ["a\x0bb\x0cc\rd", "a b"])
    assert got == [["a", "b", "c", "d"], ["a b"]]


def test_loader_fail_fast(spark, tmp_dir):
    import pytest

    dump = os.path.join(tmp_dir, "d")
    os.makedirs(dump)
    with open(os.path.join(dump, "x.xml"), "w") as fh:
        fh.write("<page><title>A</title><text>a</text></page>\n<page><title>B<text>x</text></page>\n")
    assert text.articles(text.load_dump(spark, dump)).count() == 1
    with pytest.raises(Exception, match="bad record: bad_xml"):
        text.articles(text.load_dump(spark, dump), fail_fast=True).collect()


def test_extraction_equals_direct_xpath(spark):
    from strandline.functions.xml import extract_first_elements

    pages = [
        "<page><title>T</title><revision><text>plain</text></revision></page>",
        "<page><title> T </title><revision id='1'><text xml:space='preserve' bytes='5'>  a b \n </text>"
        "</revision></page>",
        "<page><title>A &amp; B &#65;</title><revision><text>x &lt;ref&gt; y</text></revision></page>",
        "<page><title></title><revision><text></text></revision></page>",
        "<page><title>T</title><revision><text>a<b>c</b>d</text></revision></page>",
        "<page><title>T</title><revision><text>x<![CDATA[y<]]>z</text></revision></page>",
        "<page><title>T</title><revision><text>x<!-- c -->z</text></revision></page>",
        "<page><title>T</title><revision><text>one</text></revision><revision><text>two</text></revision></page>",
        "<page><title>T1</title><title>T2</title><revision><text>t</text></revision></page>",
        "<page><revision><title>inner</title><text>t</text></revision></page>",
        "<page><titlex>no</titlex><title>T</title><revision><text>t</text></revision></page>",
        "<page><title>T</title><text>direct</text></page>",
        "<page><title>T</title><revision><text/></revision></page>",
        "<page><x:title xmlns:x='u'>ns</x:title><title>T</title><revision><text>t</text></revision></page>",
        "<page><title>T</title><!-- <title>c</title> --><revision><text>t</text></revision></page>",
        "<page><title>T</title><revision><text>a\r\nb</text></revision></page>",
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, f string")
    got = extract_first_elements(df, "f", ["title", "text"])
    xp = "concat(count(//title), '|', count(//text), '|', string((//title)[1]), '|', string((//text)[1]))"
    want = df.select("i", F.xpath_string("f", F.lit(xp)).alias("x"))
    w = {r.i: r.x for r in want.collect()}
    for r in got.collect():
        assert r.ok
        assert f"{r.n_title}|{r.n_text}|{r.title}|{r.text}" == w[r.i], pages[r.i]


def test_dump_round_trip_keeps_carriage_returns_and_quarantines_controls(spark, tmp_dir):
    src = spark.createDataFrame([("cr", "a\r\nb\rc"), ("ctl", "bad\x01char"), ("ok", "plain")],
                                "title string, text string")
    dump = os.path.join(tmp_dir, "dump")
    write_dump(src.select(render_page(F.col("title"), F.col("text")).alias("page")), dump, root=None)
    rows = {r.title or r.reason: r for r in text.load_dump(spark, dump).collect()}
    assert rows["cr"].text == "a\r\nb\rc" and rows["ok"].text == "plain"
    assert rows["bad_xml"].reason == "bad_xml"


def test_tokenizing_stays_inside_the_generator(spark):
    # With tokens computed in a projection below the explode, Spark infers a
    # size(tokens) > 0 filter and pushes it under the exchange: the text is
    # then tokenized twice. words() keeps the tokenizer inside the generator.
    import re

    plan = text.word_count(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"(^|[-:] )Filter ", plan, re.M), plan
