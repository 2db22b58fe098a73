"""Property tests: tokenizer against Java split rules, log render/parse round trip.

Each property draws a batch of examples and checks them in one Spark job.
"""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.functions.logs import parse_access_log, render_log_line
from strandline.functions.text import tokenize

JAVA_WS = re.compile(r"[ \t\n\x0b\x0c\r]+")


def java_split(s: str) -> list[str]:
    """``String.split("\\\\s+")``: no match gives the input; trailing empties dropped."""
    if s == "":
        return [""]
    parts = JAVA_WS.split(s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.text(alphabet=["a", "b", "é", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\xa0"], max_size=12),
                min_size=1, max_size=40))
def test_tokenize_matches_java_split(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.t for r in df.select("i", tokenize("text").alias("t")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == java_split(t), repr(t)


_tok = st.text(alphabet=st.characters(min_codepoint=33, max_codepoint=126, exclude_characters='"'),
               min_size=1, max_size=12)
_ua = st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x2FF, exclude_characters='"\x7f'),
              min_size=1, max_size=20)
_record = st.tuples(
    _tok, _tok, _tok,
    st.integers(min_value=0, max_value=2**31 - 1), st.integers(min_value=0, max_value=2**63 - 1), _ua,
    st.datetimes(min_value=dt.datetime(1000, 1, 1), max_value=dt.datetime(9999, 12, 30)),
    st.integers(min_value=-18 * 60, max_value=18 * 60),
)


@SETTINGS
@given(st.lists(_record, min_size=1, max_size=30))
def test_render_parse_round_trip(spark, recs):
    rows = [(i, ip, m, r, s, b, ua, t.replace(microsecond=0), off)
            for i, (ip, m, r, s, b, ua, t, off) in enumerate(recs)]
    df = spark.createDataFrame(rows, "i int, ip string, method string, resource string, status int, "
                                     "bytes bigint, ua string, local timestamp_ntz, off int")
    # render with the record's own offset, then parse back
    sign = F.when(F.col("off") < 0, F.lit("-")).otherwise(F.lit("+"))
    off_s = F.concat(sign, F.lpad((F.abs("off") / 60).cast("int").cast("string"), 2, "0"),
                     F.lpad((F.abs("off") % 60).cast("string"), 2, "0"))
    line = render_log_line(F.col("ip"), F.col("local"), F.col("method"), F.col("resource"), F.col("status"),
                           F.col("bytes"), F.lit("http://r/"), F.col("ua"))
    line = F.regexp_replace(line, r" \+0000\] ", F.concat(F.lit(" "), off_s, F.lit("] ")))
    parsed = parse_access_log(df.select("i", line.alias("line")), "line")
    got = {r.i: r for r in parsed.collect()}
    for i, ip, m, r, s, b, ua, t, off in rows:
        g = got[i]
        assert g.reason is None, g.line
        assert (g.ip, g.method, g.resource, g.status, g.bytes, g.user_agent) == (ip, m, r, s, b, ua)
        assert g.local_ts == t and g.offset_min == off
        assert g.ts == t - dt.timedelta(minutes=off)


_xml_char = st.characters(blacklist_categories=("Cs",), min_codepoint=9,
                          blacklist_characters=[chr(c) for c in range(0x0B, 0x0D)] + [chr(c) for c in range(0x0E, 0x20)]
                          + ["\ufffe", "\uffff"])


@SETTINGS
@given(st.lists(st.tuples(st.text(alphabet=_xml_char, max_size=15), st.text(alphabet=_xml_char, max_size=60)),
                min_size=1, max_size=25))
def test_dump_round_trip_any_text(spark, tmp_path_factory, pages):
    import os

    from strandline.plans.text import articles, load_dump
    from strandline.sources.xmldump import render_page, write_dump

    df = spark.createDataFrame(pages, "title string, text string")
    path = os.path.join(str(tmp_path_factory.mktemp("dump")), "d")
    write_dump(df.select(render_page(F.col("title"), F.col("text")).alias("page")), path, root=None)
    got = sorted(tuple(r) for r in articles(load_dump(spark, path)).collect())
    assert got == sorted(pages)


def cut_model(line: str, n: int) -> str:
    """``cut -d ' ' -f n``: a line without the delimiter is printed whole."""
    if " " not in line:
        return line
    parts = line.split(" ")
    return parts[n - 1] if n <= len(parts) else ""


@SETTINGS
@given(st.lists(st.text(alphabet=["a", "1", " ", ":", "M", "B", "%"], max_size=14), min_size=1, max_size=40))
def test_cut_field_matches_cut(spark, lines):
    from strandline.functions.metrics import cut_field

    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, l string")
    got = {r.i: r.f for r in df.select("i", cut_field("l", 3).alias("f")).collect()}
    for i, s in enumerate(lines):
        assert got[i] == cut_model(s, 3), repr(s)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(0, 10**12)), min_size=1, max_size=40))
def test_percent_is_truncated_like_scale_4(spark, pairs):
    from strandline.operators.aggregate import pct_columns

    df = spark.createDataFrame([(i, u, a) for i, (u, a) in enumerate(pairs)], "i int, u bigint, a bigint")
    got = {r.i: (r.pct_x100, r.pct) for r in pct_columns(df, "u", "a").collect()}
    for i, (u, a) in enumerate(pairs):
        want = 0 if a == 0 else (u * 10000) // a
        assert got[i] == (want, Decimal(want) / 100)


def category_model(ua: str) -> str:
    for needle, name in [("OPR", "OPERA"), ("Chrome", "CHROME"), ("Safari", "SAFARI"),
                         ("Firefox", "FIREFOX"), ("Trident", "IE")]:
        if needle in ua:
            return name
    return "OTHER"


_ua_bits = st.sampled_from(["OPR", "Chrome", "Safari", "Firefox", "Trident", "chrome", "Opera", " ", "/5.0", "é"])


@SETTINGS
@given(st.lists(st.lists(_ua_bits, max_size=5).map("".join), min_size=1, max_size=40),
       st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=20), min_size=1, max_size=20))
def test_categories_and_anonymisation(spark, uas, ips):
    import base64
    import hashlib

    from strandline.functions.logs import anonymize, categorize_ua

    df = spark.createDataFrame([(i, u) for i, u in enumerate(uas)], "i int, ua string")
    got = {r.i: r.c for r in df.select("i", categorize_ua("ua").alias("c")).collect()}
    assert all(got[i] == category_model(u) for i, u in enumerate(uas))
    dg = spark.createDataFrame([(i, s) for i, s in enumerate(ips)], "i int, ip string")
    anon = {r.i: r.a for r in dg.select("i", anonymize("ip").alias("a")).collect()}
    for i, s in enumerate(ips):
        want = base64.b64encode(hashlib.md5(s.encode("utf-8")).digest()).decode()
        assert anon[i] == want, repr(s)


_word = st.text(alphabet=["a", "b", " ", "é"], min_size=1, max_size=6)
_segment = st.one_of(
    st.tuples(st.just("good"), _word, _word),
    st.tuples(st.just("junk"), st.text(alphabet=["x", " ", "\n", "<", ">"], max_size=8), st.just("")),
    st.tuples(st.just("unclosed"), _word, st.just("")),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_segment, min_size=1, max_size=12))
def test_scan_reads_every_closed_page_once(spark, tmp_path_factory, segments):
    import os

    from strandline.plans.text import load_dump

    parts = []
    for kind, a, b in segments:
        if kind == "good":
            parts.append(f"<page><title>{a}</title><text>{b}</text></page>")
        elif kind == "junk":
            parts.append(b.replace("<", "").replace(">", "") + a.replace("<", "").replace(">", ""))
        else:
            parts.append(f"<page><title>{a}</title>")
    parts.append("<page><title>end</title><text>z</text></page>\n")  # a file ends with a closed page
    path = str(tmp_path_factory.mktemp("scan"))
    with open(os.path.join(path, "dump.xml"), "w", encoding="utf-8") as fh:
        fh.write("".join(parts))
    rows = load_dump(spark, path).collect()
    good = sorted((r.title, r.text) for r in rows if r.reason is None)
    want = sorted([(a, b) for k, a, b in segments if k == "good"] + [("end", "z")])
    assert good == want
    # every unclosed page ends up in a quarantined head (several in a row share one)
    heads = "".join(r.fragment for r in rows if r.reason == "unclosed_page")
    assert heads.count("<page>") == sum(1 for k, _, _ in segments if k == "unclosed")
