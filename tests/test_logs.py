"""Access-log parsing: the reference's unit cases, edge lines, time zones, round trip."""

from __future__ import annotations

import base64
import datetime as dt
import hashlib

import pytest
from input_folders import SF001
from pyspark.sql import functions as F

from strandline.functions.logs import (
    anonymize,
    categorize_ua,
    decode_line,
    parse_access_log,
    render_log_line,
    render_record,
    row_key,
)
from strandline.operators.quarantine import quarantined_rows, valid_rows
from strandline.plans import logs

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def _clf(t: dt.datetime) -> str:
    off = t.utcoffset() or dt.timedelta(0)
    mins = int(off.total_seconds() // 60)
    sign = "-" if mins < 0 else "+"
    return (f"{t.day:02d}/{MONTHS[t.month - 1]}/{t.year:04d}:{t.hour:02d}:{t.minute:02d}:{t.second:02d} "
            f"{sign}{abs(mins) // 60:02d}{abs(mins) % 60:02d}")


def _line(time_s: str, ua: str = "MyBrowser", nbytes: str = "123", status: str = "200") -> str:
    return (f'203.0.113.101 - - [{time_s}] "GET /index.html HTTP/1.0" {status} {nbytes} '
            f'"http://example.com" "{ua}"')


def _parse(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "id bigint, line string")
    return {r.id: r for r in parse_access_log(df, "line").collect()}


# --- the reference's three unit cases ----------------------------------------

def test_parsing_current_time(spark):
    now = dt.datetime.now().astimezone().replace(microsecond=0)
    r = _parse(spark, [_line(_clf(now))])[0]
    assert r.reason is None
    assert r.ip == "203.0.113.101"
    utc = now.astimezone(dt.timezone.utc).replace(tzinfo=None)
    assert r.ts == utc  # compared as instants
    assert (r.method, r.resource, r.status, r.bytes, r.user_agent) == ("GET", "/index.html", 200, 123, "MyBrowser")


def test_processing_replaces_address_and_agent(spark):

    from strandline.plans.logs import process_lines

    df = spark.createDataFrame([(7, _line("05/Nov/2017:01:30:00 +0000", ua="Mozilla Firefox/1"))], "id bigint, line string")
    r = process_lines(df, ["id"]).first()
    ip = base64.b64encode(hashlib.md5(b"203.0.113.101").digest()).decode()
    assert (r.ip, r.user_agent, r.reason) == (ip, "FIREFOX", None)
    assert r.record == f"{ip} 2017-11-05T01:30Z GET /index.html 200 123 FIREFOX"


# --- edge lines ------------------------------------------------------------------

def test_edge_lines(spark):
    base_t = "05/Nov/2017:01:30:00 -0500"
    lines = [
        _line(base_t),                               # 0 valid
        _line(base_t) + "\n",                         # 1 final newline: valid (Java $)
        _line(base_t, nbytes="-"),                    # 2 no_match
        _line(base_t, ua=""),                         # 3 no_match
        _line(base_t, ua='a"b'),                      # 4 no_match
        _line(base_t, status="99999999999"),          # 5 bad_number
        _line("33/Nov/2017:01:30:00 +0000"),          # 6 bad_time
        _line("05/nov/2017:01:30:00 +0000"),          # 7 month is case-sensitive: bad_time
        _line(base_t, nbytes="99999999999999999999"),  # 8 bad_number (beyond bigint)
        _line(base_t, ua="with\u0001ctl"),            # 9 exact path, still valid
        "bad line",                                   # 10 no_match
        _line("05/Nov/2017:01:30:00 +1960"),          # 11 bad offset: bad_time
        _line(base_t) + "\r\n",                       # 12 CRLF end: valid (Java $)
        _line(base_t) + "\n\n",                       # 13 two newlines: no_match
        _line("05/Nov/2017:01:30:60 +0000"),          # 14 second 60: bad_time
        _line("05/Nov/2017:24:00:00 +0000"),          # 15 end of the day: next midnight
        _line("05/Nov/2017:01:30:00 +1830"),          # 16 beyond +18:00: bad_time
        _line("05/Nov/2017:01:30:00 -1800"),          # 17 -18:00: valid
        _line("01/Jan/0000:00:00:00 +0000"),          # 18 year 0: bad_time
        _line("29/Feb/2017:00:00:00 +0000"),          # 19 no 29 Feb: the month's last day
        _line("29/Feb/2016:00:00:00 +0000"),          # 20 leap day: valid
        _line("31/Apr/2017:23:59:59 +0000"),          # 21 the month's last day
        _line("05/Nov/2017:24:00:01 +0000"),          # 22 past the end of the day: bad_time
        _line("00/Nov/2017:01:00:00 +0000"),          # 23 day 0: bad_time
        _line("31/Dec/2017:24:00:00 +0000"),          # 24 next year
    ]
    got = _parse(spark, lines)
    reasons = [got[i].reason for i in range(len(lines))]
    assert reasons == [None, None, "no_match", "no_match", "no_match", "bad_number", "bad_time", "bad_time",
                       "bad_number", None, "no_match", "bad_time", None, "no_match", "bad_time", None, "bad_time", None, "bad_time", None, None,
                       None, "bad_time", "bad_time", None]
    assert got[15].ts == dt.datetime(2017, 11, 6) and got[24].ts == dt.datetime(2018, 1, 1)
    assert got[19].ts == dt.datetime(2017, 2, 28) and got[21].ts == dt.datetime(2017, 4, 30, 23, 59, 59)
    assert got[12].user_agent == "MyBrowser"
    assert got[1].user_agent == "MyBrowser"
    assert got[9].user_agent == "with\u0001ctl" and got[9].bytes == 123
    assert got[0].ts == dt.datetime(2017, 11, 5, 6, 30)
    assert got[0].local_ts == dt.datetime(2017, 11, 5, 1, 30) and got[0].offset_min == -300


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_time_is_session_zone_free(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = _parse(spark, [_line("05/Nov/2017:01:30:00 -0500"), _line("12/Mar/2017:02:30:00 +0000")])
        assert got[0].ts == dt.datetime(2017, 11, 5, 6, 30)
        assert got[1].ts == dt.datetime(2017, 3, 12, 2, 30)
        df = spark.createDataFrame([(dt.datetime(2017, 3, 12, 2, 30, 5),)], "ts timestamp_ntz")
        line = df.select(render_log_line(F.lit("1.2.3.4"), F.col("ts"), F.lit("GET"), F.lit("/"), F.lit(200),
                                         F.lit(1), F.lit("r"), F.lit("u")).alias("l")).first().l
        assert "[12/Mar/2017:02:30:05 +0000]" in line
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_null_line_is_no_match(spark):
    df = spark.createDataFrame([(0, None)], "id bigint, line string")
    r = parse_access_log(df, "line").first()
    assert r.reason == "no_match" and r.ip is None


def test_bad_utf8_becomes_replacement_char(spark):
    df = spark.createDataFrame([(bytearray(b"a\xff"),)], "value binary")
    assert df.select(decode_line("value").alias("s")).first().s == "a�"


def test_render_then_parse_round_trip(spark):
    lines = logs.log_lines(spark, SF001)
    parsed = valid_rows(parse_access_log(lines, "line"))
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    joined = parsed.join(ev.select("event_id", F.col("ts").alias("ev_ts"), "event_type", "value"), "event_id")
    bad = joined.where(
        (F.col("ts") != F.date_trunc("second", F.col("ev_ts")).cast("timestamp_ntz"))
        | (F.col("resource") != F.concat(F.lit("/"), F.col("event_type")))
        | (F.col("bytes") != F.floor(F.col("value") * 10)))
    assert bad.count() == 0
    assert parsed.count() == ev.where(F.col("event_id") % 50 != 49).count()


def test_categories_follow_fixed_order(spark):
    uas = ["x OPR Chrome Safari", "Chrome Safari", "Safari", "Firefox", "Trident", "curl", "chrome"]
    df = spark.createDataFrame([(u,) for u in uas], "ua string")
    got = [r.c for r in df.select(categorize_ua("ua").alias("c")).collect()]
    assert got == ["OPERA", "CHROME", "SAFARI", "FIREFOX", "IE", "OTHER", "OTHER"]


def test_expected_category_counts(spark):
    counts = dict(logs.log_ua_counts(spark, "/root/testdata/sf0.01").collect())
    assert counts == {"CHROME": 2800, "SAFARI": 1400, "FIREFOX": 1400, "OPERA": 1400, "IE": 1400, "OTHER": 1400}


def test_anonymize_is_base64_md5(spark):
    df = spark.createDataFrame([("203.0.113.101",)], "ip string")
    want = base64.b64encode(hashlib.md5(b"203.0.113.101").digest()).decode()
    assert df.select(anonymize("ip").alias("a")).first().a == want
    salted = df.select(anonymize("ip", salt="k").alias("a")).first().a
    assert salted == hashlib.sha256(b"k203.0.113.101").hexdigest()


def test_row_key_is_deterministic(spark):
    df = logs.log_lines(spark, SF001).select("event_id", row_key("event_id", "line").alias("k"))
    a = sorted(tuple(r) for r in df.collect())
    b = sorted(tuple(r) for r in df.collect())
    assert a == b and len({k for _, k in a}) == len(a)


def test_record_rendering_iso_time(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 11, 5, 1, 30), -300, 0),
                                (dt.datetime(2017, 11, 5, 1, 30, 7), 0, 1),
                                (dt.datetime(2017, 11, 5, 1, 30, 7), 330, 2)],
                               "t timestamp_ntz, off int, k int")
    rec = render_record(F.lit("ip"), F.col("t"), F.col("off"), F.lit("GET"), F.lit("/r"), F.lit(200),
                        F.lit(5).cast("bigint"), F.lit("UA"))
    got = [r.s for r in df.orderBy("k").select(rec.alias("s")).collect()]
    assert got == ["ip 2017-11-05T01:30-05:00 GET /r 200 5 UA", "ip 2017-11-05T01:30:07Z GET /r 200 5 UA",
                   "ip 2017-11-05T01:30:07+05:30 GET /r 200 5 UA"]


def test_fail_fast_raises(spark):
    df = spark.createDataFrame([(0, "bad line")], "id bigint, line string")
    with pytest.raises(Exception, match="bad record"):
        valid_rows(parse_access_log(df, "line"), fail_fast=True).collect()


def test_quarantine_keeps_every_bad_line(spark):
    q = quarantined_rows(parse_access_log(logs.log_lines(spark, SF001), "line"))
    assert q.count() == 20  # 1000 events, every 50th broken


def test_parse_is_narrow_and_runs_once(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    df = logs.process_records(logs.events_to_log_lines(ev), ["event_id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # the parse runs once: a single regexp_replace, below the generator, filter above it
    assert plan.count("regexp_replace(") == 1
    assert plan.index("Filter") < plan.index("Generate")


def test_split_write_is_one_pass_partitioned_by_outcome(spark, tmp_dir):
    from strandline.operators.quarantine import write_split

    from pyspark.sql import Observation

    parsed = parse_access_log(logs.log_lines(spark, SF001), "line")
    counts = Observation("split")
    write_split(parsed, tmp_dir, counter=counts)
    assert counts.get == {"valid": 980, "quarantined": 20}
    assert sorted(d for d in __import__("os").listdir(tmp_dir) if d.startswith("outcome=")) == [
        "outcome=no_match", "outcome=valid"]
    back = spark.read.parquet(tmp_dir)
    assert back.where("outcome = 'valid'").count() == 980
    assert back.where("outcome = 'no_match'").count() == 20


def test_cli_log_batch(spark, tmp_dir):
    import os

    from strandline.cli import main

    src, out = os.path.join(tmp_dir, "logs"), os.path.join(tmp_dir, "out")
    logs.log_lines(spark, SF001).select(F.col("line").alias("value")).write.text(src)
    assert main(["log-batch", src, out]) == 0
    back = spark.read.parquet(out)
    assert back.where("outcome = 'valid'").count() == 980
    assert back.where("outcome = 'no_match'").count() == 20
    r = back.where("outcome = 'valid'").first()
    assert r.user_agent in {"CHROME", "FIREFOX", "SAFARI", "OPERA", "IE", "OTHER"} and len(r.row_key) == 64
