"""DuckDB statements that compute each query's rows without Spark.

They run over the pre-registered table views (``events``, ``documents``, ...)
and are used only to check results.
"""

from __future__ import annotations

from strandline.functions.logs import CLF_PATTERN, UA_CATEGORIES, UA_OTHER
from strandline.plans.logs import BAD_LINE_EVERY, FIXTURE_AGENTS, FIXTURE_REFERER


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


AGENTS_LIST = "[" + ", ".join(_q(a) for a in FIXTURE_AGENTS) + "]"

LOG_LINES = f"""
SELECT event_id,
  CASE WHEN event_id % {BAD_LINE_EVERY} = {BAD_LINE_EVERY - 1}
       THEN 'bad line ' || CAST(event_id AS VARCHAR)
  ELSE '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR)
    || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "'
    || CASE event_type WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'PUT' ELSE 'GET' END
    || ' /' || event_type || ' HTTP/1.0" '
    || CASE WHEN event_type = 'error' THEN '404' ELSE '200' END || ' '
    || CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR)
    || ' "{FIXTURE_REFERER}" "' || ({AGENTS_LIST})[event_id % {len(FIXTURE_AGENTS)} + 1] || '"'
  END AS line
FROM events"""

# parsed lines: all rows, NULL fields where the line is bad, plus reason
LOG_PARSED = f"""
WITH l AS ({LOG_LINES}),
m AS (
  SELECT event_id, line, regexp_full_match(line, {_q(CLF_PATTERN)}) AS matched,
         regexp_extract(line, {_q(CLF_PATTERN)},
                        ['ip', 't', 'method', 'resource', 'status', 'bytes', 'ua']) AS g
  FROM l),
f AS (
  SELECT event_id, line, matched,
         CASE WHEN matched THEN g.ip END AS ip,
         CASE WHEN matched THEN try_strptime(substr(g.t, 1, 20), '%d/%b/%Y:%H:%M:%S') END AS local_ts,
         CASE WHEN matched THEN (CASE WHEN substr(g.t, 22, 1) = '-' THEN -1 ELSE 1 END)
              * (TRY_CAST(substr(g.t, 23, 2) AS INTEGER) * 60 + TRY_CAST(substr(g.t, 25, 2) AS INTEGER)) END
           AS offset_min,
         CASE WHEN matched THEN g.method END AS method,
         CASE WHEN matched THEN g.resource END AS resource,
         CASE WHEN matched THEN TRY_CAST(g.status AS INTEGER) END AS status,
         CASE WHEN matched THEN TRY_CAST(g.bytes AS BIGINT) END AS bytes,
         CASE WHEN matched THEN g.ua END AS user_agent
  FROM m)
SELECT event_id, line, ip, local_ts - to_minutes(offset_min) AS ts, local_ts, offset_min,
       method, resource, status, bytes, user_agent,
       CASE WHEN NOT matched THEN 'no_match'
            WHEN local_ts IS NULL OR offset_min IS NULL THEN 'bad_time'
            WHEN status IS NULL OR bytes IS NULL THEN 'bad_number' END AS reason
FROM f"""

LOG_VALID = f"SELECT * FROM ({LOG_PARSED}) WHERE reason IS NULL"

UA_CASE = ("CASE " + " ".join(f"WHEN contains(user_agent, {_q(n)}) THEN {_q(c)}" for n, c in UA_CATEGORIES)
           + f" ELSE {_q(UA_OTHER)} END")

ISO_TIME = """strftime(local_ts, '%Y-%m-%dT%H:%M')
  || CASE WHEN second(local_ts) = 0 THEN '' ELSE strftime(local_ts, ':%S') END
  || CASE WHEN offset_min = 0 THEN 'Z'
          ELSE (CASE WHEN offset_min < 0 THEN '-' ELSE '+' END)
               || lpad(CAST(abs(offset_min) // 60 AS VARCHAR), 2, '0') || ':'
               || lpad(CAST(abs(offset_min) % 60 AS VARCHAR), 2, '0') END"""


def record_sql(ip: str, ua: str) -> str:
    return (f"{ip} || ' ' || {ISO_TIME} || ' ' || method || ' ' || resource || ' ' "
            f"|| CAST(status AS VARCHAR) || ' ' || CAST(bytes AS VARCHAR) || ' ' || {ua}")


LOG_PROCESS = f"""
SELECT event_id, sha256(CAST(event_id AS VARCHAR) || '|' || line) AS row_key,
       to_base64(unhex(md5(ip))) AS ip, ts, method, resource, status, bytes,
       {UA_CASE} AS user_agent,
       {record_sql("to_base64(unhex(md5(ip)))", UA_CASE)} AS record
FROM ({LOG_VALID})"""

LOGS: dict[str, str] = {
    "log_lines": LOG_LINES,
    "log_parse": f"""
SELECT event_id, ip, ts, local_ts, offset_min, method, resource, status, bytes, user_agent
FROM ({LOG_VALID})""",
    "log_quarantine": f"SELECT event_id, line, reason FROM ({LOG_PARSED}) WHERE reason IS NOT NULL",
    "log_anonymize": f"SELECT event_id, to_base64(unhex(md5(ip))) AS ip_anon FROM ({LOG_VALID})",
    "log_ua_category": f"SELECT event_id, {UA_CASE} AS ua_category FROM ({LOG_VALID})",
    "log_ua_counts": f"SELECT {UA_CASE} AS ua_category, count(*) AS n FROM ({LOG_VALID}) GROUP BY 1",
    "log_keyed": f"SELECT event_id, sha256(CAST(event_id AS VARCHAR) || '|' || line) AS row_key FROM ({LOG_VALID})",
    "log_render": f"SELECT event_id, {record_sql('ip', 'user_agent')} AS record FROM ({LOG_VALID})",
    "log_process": LOG_PROCESS,
    "log_batch_replayed": f"SELECT p.* EXCLUDE (event_id, row_key), l.line FROM ({LOG_PROCESS}) p JOIN ({LOG_LINES}) l USING (event_id)",
}

_NODES = """
SELECT r_name AS cluster, s_name AS node, s_suppkey, s_acctbal
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

_NODE_MEM = f"""
SELECT cluster, node, CAST(floor(abs(s_acctbal)) AS BIGINT) AS used_mb, CAST(16384 AS BIGINT) AS capacity_mb
FROM ({_NODES})"""


def _pct(num: str, den: str) -> str:
    x100 = f"CAST(coalesce(({num} * 10000) // nullif({den}, 0), 0) AS BIGINT)"
    return f"{x100} AS pct_x100, CAST(CAST({x100} AS DECIMAL(20, 0)) / 100 AS DECIMAL(20, 2)) AS pct"


_UTIL = f"""
SELECT cluster, CAST(sum(used_mb) AS BIGINT) AS used_mb, CAST(sum(capacity_mb) AS BIGINT) AS capacity_mb,
       {_pct('sum(used_mb)', 'sum(capacity_mb)')}
FROM ({_NODE_MEM}) GROUP BY cluster"""

_SAMPLES = """
SELECT ts, event_type AS cluster, CAST(floor(value * 10) AS BIGINT) AS used_mb,
       CAST(CASE WHEN event_type = 'signup' THEN 0 ELSE 4096 END AS BIGINT) AS capacity_mb
FROM events"""

_BY_WINDOW = f"""
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       cluster, CAST(sum(used_mb) AS BIGINT) AS used_mb, CAST(sum(capacity_mb) AS BIGINT) AS capacity_mb,
       {_pct('sum(used_mb)', 'sum(capacity_mb)')}
FROM ({_SAMPLES}) GROUP BY 1, 2, 3"""

_DFS = "SELECT r_name AS cluster, CAST(r_regionkey + 0.25 AS DECIMAL(20, 2)) AS dfs_used_pct FROM region"

_ALL_CLUSTERS = f"""
SELECT c.cluster, CAST(coalesce(sum(used_mb), 0) AS BIGINT) AS used_mb, CAST(coalesce(sum(capacity_mb), 0) AS BIGINT) AS capacity_mb,
       {_pct('coalesce(sum(used_mb), 0)', 'coalesce(sum(capacity_mb), 0)')}
FROM (SELECT unnest([r_name, r_name || ' STANDBY']) AS cluster FROM region) c
LEFT JOIN (SELECT r_name AS cluster, floor(abs(s_acctbal))::BIGINT AS used_mb, 16384 AS capacity_mb
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey % 10 <> 7) n USING (cluster)
GROUP BY 1"""

# windows that have ended a day before the last sample, from the first sample's on
_ALL_WINDOWS = f"""
WITH bounds AS (SELECT date_trunc('day', min(ts)) AS low, max(ts) - INTERVAL 1 DAY AS mark FROM events),
windows AS (SELECT unnest(generate_series(low, mark, INTERVAL 1 DAY)) AS w FROM bounds),
closed AS (SELECT w FROM windows, bounds WHERE w + INTERVAL 1 DAY <= mark),
last AS (SELECT max(date_trunc('day', ts)) AS w FROM events, bounds WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= mark),
roster AS (SELECT unnest([event_type, event_type || ' STANDBY']) AS cluster FROM (SELECT DISTINCT event_type FROM events))
SELECT g.w AS window_start, g.w + INTERVAL 1 DAY AS window_end, g.cluster, CAST(coalesce(sum(used_mb), 0) AS BIGINT) AS used_mb,
       CAST(coalesce(sum(capacity_mb), 0) AS BIGINT) AS capacity_mb, {_pct('coalesce(sum(used_mb), 0)', 'coalesce(sum(capacity_mb), 0)')}
FROM (SELECT closed.w, cluster FROM closed, roster, last WHERE closed.w <= last.w) g
LEFT JOIN ({_SAMPLES}) s ON s.cluster = g.cluster AND date_trunc('day', s.ts) = g.w
GROUP BY 1, 2, 3"""

METRICS: dict[str, str] = {
    "utilisation_all_clusters": _ALL_CLUSTERS,
    "stream_utilisation_all": _ALL_WINDOWS,
    "report_fields": _NODE_MEM,
    "report_first_match": _DFS,
    "utilisation": _UTIL,
    "utilisation_by_window": _BY_WINDOW,
    "metric_points": f"""
SELECT 'YarnMemUsage' AS metric, 'HadoopClusters' AS namespace, 'Percent' AS unit, (SELECT max(ts) FROM events) AS time,
       pct AS value, 'Cluster' AS dim_name, cluster AS dim_value FROM ({_UTIL})
UNION ALL
SELECT 'DFSUsed', 'HadoopClusters', 'Percent', (SELECT max(ts) FROM events), dfs_used_pct, 'Cluster', cluster FROM ({_DFS})""",
}


# 32-bit mixing written out: multiply, fold the upper half in, multiply, fold again; the
# start and the second factor differ by column. Then cumulative weights times 2^32.
def _mixed(start: int, factor: int) -> str:
    first = f"((((event_id % 4294967296 + 4294967296) % 4294967296 + {start}) % 4294967296)::HUGEINT * 2654435761) % 4294967296"
    folded = f"xor(({first})::BIGINT, (({first})::BIGINT >> 16))"
    second = f"(({folded})::HUGEINT * {factor}) % 4294967296"
    return f"xor(({second})::BIGINT, (({second})::BIGINT >> 15))"


_WEIGHTED = f"""
SELECT event_id,
  CASE WHEN h1 * 85 < 214748364800 THEN 'web' WHEN h1 * 85 < 343597383680 THEN 'app' ELSE 'partner' END AS channel,
  CASE WHEN h2 * 10 < 25769803776 THEN 'basic' WHEN h2 * 10 < 38654705664 THEN 'plus' ELSE 'pro' END AS tier,
  CASE WHEN h3 * 725 < 858993459200 THEN 'low' WHEN h3 * 725 < 3006477107200 THEN 'normal' ELSE 'high' END AS priority,
  CAST(h4 % 10000 AS BIGINT) AS units
FROM (SELECT event_id, {_mixed(2654435769, 3266489917)} AS h1, {_mixed(1013904242, 668265263)} AS h2,
             {_mixed(3668340011, 374761393)} AS h3, {_mixed(2027808484, 2246822519)} AS h4 FROM events)"""

# the alias table by running sums: deficits and surpluses laid on one line, met by ASOF joins
_SUPPLIER = f"""
WITH w AS (SELECT s_suppkey AS v, row_number() OVER (ORDER BY s_suppkey) - 1 AS i, floor(abs(s_acctbal))::HUGEINT * count(*) OVER () AS x,
                  sum(floor(abs(s_acctbal))::HUGEINT) OVER () AS t, count(*) OVER () AS n
           FROM supplier WHERE floor(abs(s_acctbal)) > 0),
low AS (SELECT *, sum(t - x) OVER (ORDER BY i) AS up_to, sum(t - x) OVER (ORDER BY i) - (t - x) AS start FROM w WHERE x < t),
high AS (SELECT *, sum(x - t) OVER (ORDER BY i) AS up_to, sum(x - t) OVER (ORDER BY i) - (x - t) AS start,
                lead(i) OVER (ORDER BY i) AS next FROM w WHERE x > t),
slots AS (
  SELECT low.i, low.v, low.x AS kept, high.i AS other, low.t, low.n FROM low ASOF JOIN high ON low.start >= high.start
  UNION ALL
  SELECT high.i, high.v, high.t - (low.up_to - high.up_to), high.next, high.t, high.n FROM high ASOF JOIN low ON high.up_to <= low.up_to
  UNION ALL
  SELECT i, v, t, i, t, n FROM w WHERE x = t),
hashes AS (SELECT event_id, {_mixed(387276957, 3266489917)} AS h, {_mixed(3041712726, 668265263)} AS coin FROM events)
SELECT event_id, CASE WHEN coin::HUGEINT * a.t < a.kept * 4294967296 THEN a.v ELSE b.v END AS s_suppkey
FROM hashes LEFT JOIN slots a ON a.i = (h::HUGEINT * a.n) // 4294967296 LEFT JOIN slots b ON b.i = a.other"""

# by position instead of by one pattern over the element
_TITLE = r"""
SELECT page_id, CASE WHEN p > 0 AND instr(rest, '</title') > 0 THEN
  replace(replace(replace(replace(replace(replace(replace(body, '&#39;', chr(39)), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'),
    '&quot;', '"'), '&apos;', chr(39)), '&amp;', '&') END AS title
FROM (
  SELECT page_id, p, lower(html[p:]) AS rest,
    substr(html, p + instr(html[p:], '>'), greatest(instr(lower(html[p:]), '</title') - instr(html[p:], '>') - 1, 0)) AS body
  FROM (SELECT page_id, html, CASE WHEN instr(lower(html), '<title>') > 0 AND (instr(lower(html), '<title ') = 0 OR instr(lower(html), '<title>') < instr(lower(html), '<title '))
    THEN instr(lower(html), '<title>') ELSE instr(lower(html), '<title ') END AS p FROM pages))"""

TEXT_EXTRA: dict[str, str] = {
    "weighted_assign": _WEIGHTED,
    "weighted_supplier": _SUPPLIER,
    "page_titles": _TITLE,
}
