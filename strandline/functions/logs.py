"""Access-log expressions: decode, parse, anonymise, categorise, key, render.

All built from Spark SQL functions; the same code runs on batch and
streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.barrier import evaluate_once

# ----------------------------------------------------------------------------
# Fixed values (must stay as written for results to agree).
#
# Access-log line pattern: ip, identity, user, [time], "method resource
# protocol", status, bytes, referer, "user agent". Java regex semantics: a
# final line terminator before the end is accepted.
CLF_PATTERN = r'^(\S+) \S+ \S+ \[([^]]+)\] "(\S+) (\S+) \S+" (\d+) (\d+) \S+ "([^"]+)"$'
CLF_FIELDS = ["ip", "time", "method", "resource", "status", "bytes", "user_agent"]
# Time layout ``dd/MMM/yyyy:HH:mm:ss Z``, English month abbreviations.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
CLF_TIME_SHAPE = r"^\d{2}/[A-Z][a-z]{2}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4}$"
# Generated line: ip - - [time] "METHOD RESOURCE HTTP/1.0" status bytes "referer" "agent"
# User-agent categories: case-sensitive substring tests, first hit wins.
UA_CATEGORIES = [("OPR", "OPERA"), ("Chrome", "CHROME"), ("Safari", "SAFARI"),
                 ("Firefox", "FIREFOX"), ("Trident", "IE")]
UA_OTHER = "OTHER"
# ----------------------------------------------------------------------------

_SEP = "\u0001"
_REPL = _SEP + _SEP.join(f"${i}" for i in range(1, len(CLF_FIELDS) + 1)) + _SEP


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_line(value: Column | str) -> Column:
    """UTF-8 bytes -> string; malformed sequences become U+FFFD, never an error."""
    return F.make_valid_utf8(_col(value).cast("string"))


def parse_clf_time(s: Column | str) -> tuple[Column, Column]:
    """``dd/MMM/yyyy:HH:mm:ss +hhmm`` -> (local wall clock NTZ, offset minutes).

    Built from the fields, so no session time zone is involved anywhere.
    Shape is checked first (two-digit fields, case-sensitive month). As the
    usual resolver of the Java time library does, a day up to 31 that its
    month lacks becomes the month's last, and ``24:00:00`` the next midnight;
    any other field out of range gives NULL. NULL for NULL input.
    """
    s = _col(s)
    shape = s.rlike(CLF_TIME_SHAPE)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(s, 4, 3))
    sign = F.when(F.substring(s, 22, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    off_h = F.substring(s, 23, 2).try_cast("int")
    off_m = F.substring(s, 25, 2).try_cast("int")
    # offsets run from -18:00 to +18:00
    offset = F.when(shape & (off_m <= 59) & (off_h * 60 + off_m <= 18 * 60), sign * (off_h * 60 + off_m))
    sec = F.substring(s, 19, 2).try_cast("int")
    year = F.substring(s, 8, 4).try_cast("int")
    # make_timestamp would roll second 60 into the next minute and accept year
    # 0; the layout allows seconds 0-59 and years of the era from 1
    day = F.substring(s, 1, 2).try_cast("int")
    hour = F.substring(s, 13, 2).try_cast("int")
    minute = F.substring(s, 16, 2).try_cast("int")
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    length = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    midnight = (hour == 24) & (minute == 0) & (sec == 0)
    at = F.try_make_timestamp_ntz(
        year, month.cast("int"), F.when((day >= 1) & (day <= 31), F.least(day, length)),
        F.when(midnight, 0).otherwise(hour), minute, sec)
    local = F.when(
        shape & (month > 0) & offset.isNotNull() & (sec <= 59) & (year >= 1),
        F.when(midnight, at + F.make_dt_interval(F.lit(1))).otherwise(at),
    )
    return local, offset


def utc_from_local(local: Column, offset_min: Column) -> Column:
    """UTC instant as TIMESTAMP_NTZ: local wall clock minus its offset."""
    return local - F.make_dt_interval(F.lit(0), F.lit(0), offset_min, F.lit(0))


def parse_access_log(df: DataFrame, line: str = "line") -> DataFrame:
    """Add the parsed fields and a ``reason`` (NULL when the line is good).

    Columns added: ``ip, ts, local_ts, offset_min, method, resource, status,
    bytes, user_agent, reason``. ``ts`` is the UTC instant, ``local_ts`` the
    wall clock as written, ``offset_min`` its offset. Reasons: ``no_match``,
    ``bad_time``, ``bad_number`` (status beyond int, bytes beyond bigint).

    One regex evaluation per line on the common path: ``regexp_replace``
    rewrites a matching line into its seven groups joined by U+0001 and a
    ``split`` takes them apart; a line that already contains U+0001 takes the
    exact path (``rlike`` + ``regexp_extract`` per group). The steps sit in
    separate projections so each expression is computed once per row, and
    the result passes :func:`evaluate_once`, so that a filter on ``reason``
    does not run the parse a second time.
    """
    ln = F.col(line)
    fast = F.instr(ln, _SEP) == 0
    parts = F.when(fast, F.split(F.regexp_replace(ln, CLF_PATTERN, _REPL), _SEP))
    out = df.withColumn("_p", parts)
    p = F.col("_p")
    matched = F.when(p.isNotNull(), F.size(p) == len(CLF_FIELDS) + 2).otherwise(ln.rlike(CLF_PATTERN))
    out = out.withColumn("_m", F.coalesce(matched, F.lit(False)))  # a NULL line does not match
    groups = {
        name: F.when(F.col("_m"), F.when(p.isNotNull(), F.get(p, i + 1))
                     .otherwise(F.regexp_extract(ln, CLF_PATTERN, i + 1)))
        for i, name in enumerate(CLF_FIELDS)
    }
    out = out.select("*", *[g.alias(f"_g_{k}") for k, g in groups.items()])
    local, offset = parse_clf_time(F.col("_g_time"))
    out = out.withColumn("local_ts", local).withColumn("offset_min", offset)
    status = F.expr("try_cast(_g_status AS INT)")
    nbytes = F.expr("try_cast(_g_bytes AS BIGINT)")
    ts = utc_from_local(F.col("local_ts"), F.col("offset_min"))
    reason = (F.when(~F.col("_m"), F.lit("no_match"))
              .when(F.col("local_ts").isNull(), F.lit("bad_time"))
              .when(status.isNull() | nbytes.isNull(), F.lit("bad_number")))
    return evaluate_once(out.select(
        *[c for c in df.columns],
        F.col("_g_ip").alias("ip"), ts.alias("ts"), "local_ts", "offset_min",
        F.col("_g_method").alias("method"), F.col("_g_resource").alias("resource"),
        status.alias("status"), nbytes.alias("bytes"), F.col("_g_user_agent").alias("user_agent"),
        reason.alias("reason"),
    ))


def anonymize(ip: Column | str, salt: str | None = None) -> Column:
    """Base64 of the 16 raw MD5 bytes of the UTF-8 address.

    MD5 of a short address space is easy to reverse; with ``salt`` a keyed
    SHA-256 is used instead (hex), for production use.
    """
    ip = _col(ip)
    if salt is not None:
        return F.sha2(F.concat(F.lit(salt), ip), 256)
    return F.base64(F.unhex(F.md5(ip)))


def categorize_ua(ua: Column | str) -> Column:
    """Browser family by substring tests in fixed order; OTHER when none hits.

    The order matters: Chrome agents also say Safari, Opera agents say both.
    """
    ua = _col(ua)
    expr = None
    for needle, name in UA_CATEGORIES:
        cond = ua.contains(needle)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(UA_OTHER))


def row_key(*cols: Column | str) -> Column:
    """Deterministic record key: SHA-256 hex of the '|'-joined columns.

    A replay or a task retry yields the same key (a random UUID would not).
    """
    return F.sha2(F.concat_ws("|", *[_col(c).cast("string") for c in cols]), 256)


def random_row_key() -> Column:
    """A random UUID per row (changes on recomputation)."""
    return F.expr("uuid()")


def iso_offset(offset_min: Column) -> Column:
    """``Z`` for 0, else ``+hh:mm`` / ``-hh:mm``."""
    a = F.abs(offset_min)
    return F.when(offset_min == 0, F.lit("Z")).otherwise(F.concat(
        F.when(offset_min < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad((a / 60).cast("int").cast("string"), 2, "0"), F.lit(":"),
        F.lpad((a % 60).cast("string"), 2, "0")))


def iso_local_time(local: Column, offset_min: Column) -> Column:
    """ISO-8601 with offset; seconds omitted when zero (``2017-11-05T01:30-05:00``).

    Printed from ``cast(ts as string)``, which does not consult the session
    time zone for TIMESTAMP_NTZ.
    """
    s = local.cast("string")
    hm = F.when(F.second(local) == 0, F.substring(s, 12, 5)).otherwise(F.substring(s, 12, 8))
    return F.concat(F.substring(s, 1, 10), F.lit("T"), hm, iso_offset(offset_min))


def render_record(ip: Column, local: Column, offset_min: Column, method: Column, resource: Column,
                  status: Column, nbytes: Column, ua: Column) -> Column:
    """``ip time method resource status bytes agent`` joined by blanks."""
    return F.concat_ws(" ", ip, iso_local_time(local, offset_min), method, resource,
                       status.cast("string"), nbytes.cast("string"), ua)


def clf_time(ts: Column | str, offset: str = "+0000") -> Column:
    """TIMESTAMP_NTZ -> ``dd/MMM/yyyy:HH:mm:ss +0000`` (from fields, zone-free)."""
    ts = _col(ts)

    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    return F.concat(
        two(F.dayofmonth(ts)), F.lit("/"), F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(ts)),
        F.lit("/"), F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit(":"), two(F.hour(ts)), F.lit(":"),
        two(F.minute(ts)), F.lit(":"), two(F.second(ts)), F.lit(" " + offset),
    )


def render_log_line(ip: Column, ts: Column, method: Column, resource: Column, status: Column,
                    nbytes: Column, referer: Column, ua: Column) -> Column:
    """``ip - - [time] "METHOD RESOURCE HTTP/1.0" status bytes "referer" "agent"``."""
    return F.concat(
        ip, F.lit(" - - ["), clf_time(ts), F.lit('] "'), method, F.lit(" "), resource,
        F.lit(' HTTP/1.0" '), status.cast("string"), F.lit(" "), nbytes.cast("string"),
        F.lit(' "'), referer, F.lit('" "'), ua, F.lit('"'),
    )
