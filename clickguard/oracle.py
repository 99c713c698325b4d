"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark code: windows come from integer
arithmetic on epoch microseconds, messages are built with DuckDB's JSON
functions and parsed back with them. Views `events` etc. are registered by
the checker. Constants are those of `EVENTS_CONFIG`.
"""

from __future__ import annotations

from clickguard.config import EVENTS_CONFIG as C

W = C.window_us
S = C.slide_us
K = -(-W // S)
MIN_E, MAX_E, RATE = C.min_events, C.max_events, C.min_rate
BAN_S = C.ban_us // 1_000_000
BAN_MS = C.ban_us // 1_000
WM_MS = C.watermark_us // 1_000
LAG_US = 600_000_000.0  # value x 10 minutes

EV = """ev AS (
  SELECT CAST(user_id AS VARCHAR) AS ip,
         CASE WHEN event_type = 'view' THEN 'watch' ELSE event_type END AS action,
         CAST(ts AS TIMESTAMP) AS eventTime,
         event_type, value, event_id
  FROM events)"""


def _arrival(t: str, v: str) -> str:
    return f"make_timestamp(epoch_us({t}) + CAST(floor({v} * {LAG_US}) AS BIGINT))"


def windows(src: str, group_time: str = "eventTime", extra_group: str = "",
            w: int = W, s: int = S) -> str:
    """CTEs `win` (rows fanned out to their windows) and `stats`."""
    eg = f", {extra_group}" if extra_group else ""
    k = -(-w // s)
    return f"""fan AS (
  SELECT *, (epoch_us({group_time}) // {s} - o) * {s} AS ws
  FROM (SELECT *, unnest(range({k})) AS o FROM {src} WHERE {group_time} IS NOT NULL)),
win AS (SELECT * FROM fan WHERE epoch_us({group_time}) < ws + {w}),
stats AS (
  SELECT ip, ws{eg},
         count(*) FILTER (WHERE action = 'click') AS clicks,
         count(*) FILTER (WHERE action = 'watch') AS watches,
         min(eventTime) AS firstEvent, max(eventTime) AS lastEvent
  FROM win GROUP BY ip, ws{eg}),
rated AS (
  SELECT *, clicks + watches AS total_events,
         CASE WHEN clicks > 0 THEN watches / clicks ELSE CAST(watches AS DOUBLE) END AS rate
  FROM stats)"""


def _t(c: str, fmt: bool) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if fmt else f"CAST({c} AS VARCHAR)"


def reason(fmt: bool = False) -> str:
    span = f"' from ', {_t('firstEvent', fmt)}, ' to ', {_t('lastEvent', fmt)}"
    return f"""CASE
    WHEN total_events >= {MAX_E}
      THEN concat('too much events: ', CAST(total_events AS VARCHAR), {span})
    WHEN rate <= {RATE}
      THEN concat('too suspicious rate: ', CAST(rate AS VARCHAR), {span})
  END"""


FIRES = f"total_events > {MIN_E} AND (total_events >= {MAX_E} OR rate <= {RATE})"


def incidents_sql(src_cte: str, src: str, fmt: bool = False, group_time="eventTime",
                  extra_cols: str = "", w: int = W, s: int = S) -> str:
    ec = f"{extra_cols}, " if extra_cols else ""
    return f"""WITH {src_cte},
{windows(src, group_time, w=w, s=s)},
inc AS (SELECT ip, {ec}lastEvent, {reason(fmt)} AS reason FROM rated WHERE {FIRES})"""


INCIDENTS = incidents_sql(EV, "ev") + "\nSELECT ip, lastEvent, reason FROM inc"

WINDOW_EVENT_STATS = f"""WITH {EV},
{windows("ev")}
SELECT ip, make_timestamp(ws) AS window_start, make_timestamp(ws + {W}) AS window_end,
       clicks, watches, total_events, rate, firstEvent, lastEvent
FROM rated"""

MERGE_PARTIALS = f"""WITH {EV},
{windows("ev")}
SELECT ip, make_timestamp(ws) AS window_start, make_timestamp(ws + {W}) AS window_end,
       clicks, watches, firstEvent, lastEvent
FROM stats"""

INCIDENTS_FORMATTED = incidents_sql(EV, "ev", fmt=True) + "\nSELECT ip, lastEvent, reason FROM inc"

ARR = f"""{EV},
arr AS (SELECT ip, action, eventTime, {_arrival('eventTime', 'value')} AS arrival FROM ev)"""

ARR_SKIP = f"""{ARR},
arr_recent AS (SELECT * FROM arr WHERE NOT (epoch_us(eventTime) < epoch_us(arrival) - {W}))"""

INCIDENTS_BY_ARRIVAL = (incidents_sql(ARR, "arr", group_time="arrival",
                                      extra_cols=f"make_timestamp(ws + {W}) AS windowEnd")
                        + "\nSELECT ip, windowEnd, lastEvent, reason FROM inc")

INCIDENTS_BY_ARRIVAL_SKIP_OLD = (
    incidents_sql(ARR_SKIP, "arr_recent", group_time="arrival",
                  extra_cols=f"make_timestamp(ws + {W}) AS windowEnd")
    + "\nSELECT ip, windowEnd, lastEvent, reason FROM inc")

HOUR_US = 3_600_000_000

# arrival rounded up to the end of its 1-hour batch interval
ARR_BATCH = f"""{ARR},
arr_batch AS (
  SELECT ip, action, eventTime,
         make_timestamp(epoch_us(arrival)
                        + ({HOUR_US} - epoch_us(arrival) % {HOUR_US}) % {HOUR_US}) AS arrival
  FROM arr)"""

INCIDENTS_BY_BATCH_TIME = (incidents_sql(ARR_BATCH, "arr_batch", group_time="arrival",
                                         extra_cols=f"make_timestamp(ws + {W}) AS windowEnd")
                           + "\nSELECT ip, windowEnd, lastEvent, reason FROM inc")

INCIDENTS_HOURLY = (incidents_sql(EV, "ev", s=HOUR_US)
                    + "\nSELECT ip, lastEvent, reason FROM inc")

PERIOD_S = f"(epoch_us(lastEvent) // 1000000 + {BAN_S}) * 1000"
PERIOD_MS = f"epoch_us(lastEvent) // 1000 + {BAN_MS}"

BAN_RECORDS = incidents_sql(EV, "ev") + f"\nSELECT ip, {PERIOD_S} AS period, reason FROM inc"
BAN_RECORDS_MS = incidents_sql(EV, "ev") + f"\nSELECT ip, {PERIOD_MS} AS period, reason FROM inc"

def _current_bans(ban_s: int) -> str:
    return incidents_sql(EV, "ev") + f""",
log AS (
  SELECT ip, (epoch_us(lastEvent) // 1000000 + {ban_s}) * 1000 AS period, reason,
         lastEvent AS written_at, 0 AS batch_id, lastEvent + INTERVAL {ban_s} SECOND AS expires_at
  FROM inc),
cut AS (SELECT max(written_at) AS t FROM log),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ip ORDER BY written_at DESC, batch_id DESC,
                                                        period DESC, reason DESC) AS rn
  FROM log WHERE written_at <= (SELECT t FROM cut))
SELECT ip, period, reason, written_at, expires_at
FROM ranked WHERE rn = 1 AND expires_at > (SELECT t FROM cut)"""


CURRENT_BANS = _current_bans(BAN_S)

# Kafka-shaped records built from `events` with DuckDB's own JSON functions.
SECONDS = "BETWEEN -62135596800 AND 253402300799"  # years 1 to 9999


def _json(**other: str | None) -> str:
    fields = {"type": "typ", "ip": "ip", "unix_time": "ut", "url": "url"} | other
    inner = ", ".join(f"'{n}', {c}" for n, c in fields.items() if c is not None)
    return f"CAST(json_object({inner}) AS VARCHAR)"


REC = f"""src AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS ip, value,
         CASE WHEN event_type = 'view' THEN 'watch' ELSE event_type END AS typ,
         epoch_us(CAST(ts AS TIMESTAMP)) // 1000000 AS ut,
         '/ad/' || CAST(event_id AS VARCHAR) AS url,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(ts AS TIMESTAMP) AS t
  FROM events),
rec AS (
  SELECT event_id AS "offset", ip AS key,
         {_arrival('t', 'value')} AS "timestamp",
         CASE WHEN k < 3 THEN concat_ws(' ', typ, ip, CAST(ut AS VARCHAR), url)
              WHEN k < 6 THEN {_json(url=None)}
              WHEN k < 9 THEN {_json(unix_time="CAST(ut AS VARCHAR)")}
              WHEN k < 10 THEN {_json(ip="CAST(ip AS BIGINT)")}
              WHEN k < 11 THEN {_json(url="json_object('path', url)")}
              WHEN k < 12 THEN {_json()} || ' end'
              WHEN k < 13 THEN {_json()} || {_json()}
              WHEN k < 14 THEN replace({_json()}, '"', '''')
              WHEN k < 15 THEN {_json(unix_time="ut * 1000000")}
              WHEN k < 16 THEN {_json(ip="NULL")}
              ELSE {_json()}
         END AS v,
         -- what a lenient parser reads: the first value, single quotes allowed
         CASE WHEN k BETWEEN 11 AND 13 THEN {_json()} END AS first_value
  FROM src),
js AS (
  SELECT *, CASE WHEN json_valid(v) AND json_type(CAST(v AS JSON)) = 'OBJECT'
                 THEN CAST(v AS JSON) END AS j
  FROM rec),
msg AS (
  SELECT "offset", key, "timestamp", v, j, coalesce(CAST(first_value AS JSON), j) AS lj,
         CASE WHEN json_type(j, '$.type') = 'VARCHAR' THEN json_extract_string(j, '$.type') END AS m_type,
         CASE WHEN json_type(j, '$.ip') = 'VARCHAR' THEN json_extract_string(j, '$.ip') END AS m_ip,
         CASE WHEN json_type(j, '$.unix_time') IN ('BIGINT', 'UBIGINT')
               AND CAST(json_extract(j, '$.unix_time') AS BIGINT) {SECONDS}
              THEN CAST(json_extract(j, '$.unix_time') AS BIGINT) END AS m_time,
         CASE WHEN json_type(lj, '$.type') = 'VARCHAR' THEN json_extract_string(lj, '$.type') END AS l_type,
         CASE WHEN json_type(lj, '$.unix_time') IN ('BIGINT', 'UBIGINT')
               AND CAST(json_extract(lj, '$.unix_time') AS BIGINT) {SECONDS}
              THEN CAST(json_extract(lj, '$.unix_time') AS BIGINT) END AS l_time,
         CASE WHEN json_type(j, '$.url') = 'VARCHAR' THEN json_extract_string(j, '$.url') END AS m_url
  FROM js)"""

ACCEPTED = ("j IS NOT NULL AND m_type IN ('click', 'watch') AND m_ip IS NOT NULL "
            "AND m_time IS NOT NULL AND m_url IS NOT NULL")

LENIENT = f"""{REC},
lenient AS (
  SELECT "offset", key AS ip, l_type AS action,
         make_timestamp(l_time * 1000000) AS eventTime, "timestamp"
  FROM msg)"""

STRICT = f"""{REC},
strict AS (
  SELECT "offset", m_ip AS ip, m_type AS action,
         make_timestamp(m_time * 1000000) AS eventTime, "timestamp"
  FROM msg WHERE {ACCEPTED})"""

PARSE_LENIENT = f"""WITH {LENIENT}
SELECT "offset", ip, action, eventTime FROM lenient"""

PARSE_STRICT = f"""WITH {STRICT}
SELECT "offset", ip, action, eventTime FROM strict"""


def _field_problem(name: str, col: str) -> str:
    return (f"WHEN {col} IS NULL AND json_extract(j, '$.{name}') IS NOT NULL "
            f"AND json_type(j, '$.{name}') <> 'NULL' THEN 'invalid field: {name}' "
            f"WHEN {col} IS NULL THEN 'missing field: {name}'")


PARSE_QUARANTINE = f"""WITH {REC}
SELECT "offset", v AS raw,
  CASE WHEN v IS NULL THEN 'empty message'
       WHEN j IS NULL THEN 'malformed json'
       {_field_problem('type', 'm_type')}
       {_field_problem('ip', 'm_ip')}
       {_field_problem('unix_time', 'm_time')}
       {_field_problem('url', 'm_url')}
       WHEN m_type NOT IN ('click', 'watch') THEN 'unknown type: ' || m_type
  END AS reason
FROM msg WHERE NOT coalesce({ACCEPTED}, false)"""

KEY_EXTRACT = f"""WITH {REC}
SELECT "offset", NULLIF(regexp_extract(v, '"ip":.?"([^"]+)"', 1), '') AS key FROM rec"""

FROM_MESSAGES = incidents_sql(LENIENT, "lenient") + \
    f"\nSELECT ip, {PERIOD_S} AS period, reason FROM inc"

FROM_MESSAGES_STRICT = incidents_sql(f"{STRICT}, arr AS (SELECT *, \"timestamp\" AS arrival FROM strict)",
                                     "arr", group_time="arrival") + \
    f"\nSELECT ip, {PERIOD_MS} AS period, reason FROM inc"

SPOOL = f"""{REC},
spool AS (
  SELECT NULLIF(regexp_extract(v, '"ip":.?"([^"]+)"', 1), '') AS ip, l_type AS action,
         make_timestamp(l_time * 1000000) AS eventTime
  FROM msg)"""

FROM_SPOOL = incidents_sql(SPOOL, "spool") + f"\nSELECT ip, {PERIOD_S} AS period, reason FROM inc"

COUNTER_TOTALS = """SELECT event_type AS key, CAST(sum(event_id) AS BIGINT) AS total,
       min(event_id) AS first, max(event_id) AS last
FROM events GROUP BY event_type"""


def _closed(src_cte: str, src: str) -> str:
    """Incidents of windows an append-mode stream has emitted after one
    batch holding everything: window end <= watermark, the watermark being
    max(eventTime) in ms minus the delay."""
    return incidents_sql(src_cte, src, extra_cols="ws") + f""",
wm AS (SELECT epoch_ms(max(eventTime)) - {WM_MS} AS w FROM {src})
SELECT ip, lastEvent, reason FROM inc
WHERE (ws + {W}) // 1000 <= (SELECT w FROM wm)"""


STREAM_APPEND = _closed(LENIENT, "lenient")
STREAM_APPEND_EVENTS = _closed(EV, "ev")

STREAM_BANS = incidents_sql(LENIENT, "lenient") + f""",
b AS (SELECT ip, {PERIOD_S} AS period, reason FROM inc),
r AS (SELECT *, row_number() OVER (PARTITION BY ip ORDER BY period DESC, reason DESC) AS rn FROM b)
SELECT ip, period, reason FROM r WHERE rn = 1"""


EV_NULLS = f"""{EV},
evn AS (SELECT CASE WHEN event_id % 13 <> 0 THEN ip END AS ip,
               CASE WHEN event_id % 7 <> 0 THEN action END AS action,
               CASE WHEN event_id % 11 <> 0 THEN eventTime END AS eventTime FROM ev),
evt AS (SELECT * FROM evn WHERE ip IS NOT NULL AND eventTime IS NOT NULL),
eva AS (SELECT * FROM evn WHERE ip IS NOT NULL AND action IS NOT NULL)"""


def _nulls(src: str, fmt: bool) -> str:
    return incidents_sql(EV_NULLS, src, fmt=fmt) + "\nSELECT ip, lastEvent, reason FROM inc"


def _batched(parsed: str, src: str, time: str) -> str:
    """Rows of a replay in four batches, fanned out to their windows, without
    those whose window had ended at the watermark of the batches before: `win`
    (ip, action, eventTime, ws, batch), with `wm` the watermark each batch
    starts with and `wm_end` the last one, in ms."""
    return f"""{parsed},
bt AS (
  SELECT s.ip, s.action, s.eventTime, s.{time} AS tm,
         least(CAST(floor((day(e.ts) - 1) / 8) AS INTEGER)
               + CASE WHEN coalesce(TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) < 20, false)
                      THEN 1 ELSE 0 END, 3) AS batch
  FROM {src} s JOIN events e ON e.event_id = s."offset"),
wm AS (SELECT b.b AS batch, (SELECT max(epoch_ms(tm)) FROM bt WHERE bt.batch < b.b) - {WM_MS} AS w
       FROM range(4) b(b)),
wm_end AS (SELECT max(epoch_ms(tm)) - {WM_MS} AS w FROM bt),
fan AS (SELECT *, (epoch_us(tm) // {S} - o) * {S} AS ws
        FROM (SELECT *, unnest(range({K})) AS o FROM bt WHERE tm IS NOT NULL)),
win AS (SELECT fan.* FROM fan JOIN wm USING (batch)
        WHERE epoch_us(tm) < ws + {W} AND (wm.w IS NULL OR ws + {W} > wm.w * 1000))"""


_STATS = """count(*) FILTER (WHERE action = 'click') AS clicks,
         count(*) FILTER (WHERE action = 'watch') AS watches,
         min(eventTime) AS firstEvent, max(eventTime) AS lastEvent"""
_RATED = """rated AS (
  SELECT *, clicks + watches AS total_events,
         CASE WHEN clicks > 0 THEN watches / clicks ELSE CAST(watches AS DOUBLE) END AS rate
  FROM stats)"""

STREAM_BANS_BY_ARRIVAL = f"""WITH {_batched(STRICT, "strict", '"timestamp"')},
changed AS (SELECT DISTINCT ip, ws, batch FROM win),
stats AS (
  SELECT c.ip, c.ws, c.batch AS seen, {_STATS}
  FROM changed c JOIN win w ON w.ip = c.ip AND w.ws = c.ws AND w.batch <= c.batch
  GROUP BY c.ip, c.ws, c.batch),
{_RATED},
b AS (SELECT ip, {PERIOD_MS} AS period, {reason()} AS reason, seen FROM rated WHERE {FIRES}),
r AS (SELECT *, row_number() OVER (PARTITION BY ip ORDER BY seen DESC, period DESC, reason DESC) AS rn FROM b)
SELECT ip, period, reason FROM r WHERE rn = 1"""

STREAM_INCIDENTS_LATE = f"""WITH {_batched(LENIENT, "lenient", "eventTime")},
stats AS (SELECT ip, ws, {_STATS} FROM win GROUP BY ip, ws),
{_RATED}
SELECT ip, lastEvent, {reason()} AS reason FROM rated
WHERE {FIRES} AND (ws + {W}) // 1000 <= (SELECT w FROM wm_end)"""


STREAM_INCIDENTS_BY_SLIDE = f"""WITH {_batched(LENIENT, "lenient", '"timestamp"')},
stats AS (SELECT ip, ws, {_STATS} FROM win GROUP BY ip, ws),
{_RATED}
SELECT ip, make_timestamp(ws + {W}) AS "windowEnd", lastEvent, {reason()} AS reason FROM rated
WHERE firstEvent IS NOT NULL AND {FIRES} AND (ws + {W}) // 1000 <= (SELECT w FROM wm_end)"""


STREAM_OPEN_WINDOWS = f"""WITH {_batched(LENIENT, "lenient", "eventTime")},
stats AS (SELECT ip, ws, {_STATS} FROM win GROUP BY ip, ws)
SELECT ip, make_timestamp(ws) AS window_start, make_timestamp(ws + {W}) AS window_end,
       clicks, watches, firstEvent, lastEvent
FROM stats WHERE (ws + {W}) // 1000 > (SELECT w FROM wm_end)"""

STREAM_INCIDENTS_DISTINCT = f"SELECT DISTINCT * FROM ({STREAM_INCIDENTS_LATE})"

# deduplication drops a record whose own time the watermark has reached
STREAM_INCIDENTS_REDELIVERED = f"""WITH {_batched(LENIENT, "lenient", "eventTime")},
timely AS (SELECT win.* FROM win JOIN wm USING (batch) WHERE wm.w IS NULL OR epoch_us(tm) > wm.w * 1000),
stats AS (SELECT ip, ws, {_STATS} FROM timely GROUP BY ip, ws),
{_RATED}
SELECT ip, lastEvent, {reason()} AS reason FROM rated
WHERE {FIRES} AND (ws + {W}) // 1000 <= (SELECT w FROM wm_end)"""


def _two_topics(policy: str, chosen: str) -> str:
    """A run's watermark comes from the newest times of its topics, and never
    goes back."""
    return f"""SELECT '{policy}' AS policy, * FROM (WITH {LENIENT},
bt AS (
  SELECT s.ip, s.action, s.eventTime, e.event_id % 2 AS topic,
         least(CAST(floor((day(e.ts) - 1) / 8) AS INTEGER) + e.event_id % 2, 3) AS batch
  FROM lenient s JOIN events e ON e.event_id = s."offset"),
runs AS (SELECT batch, max(epoch_ms(eventTime)) FILTER (WHERE topic = 0) AS a,
                max(epoch_ms(eventTime)) FILTER (WHERE topic = 1) AS b FROM bt GROUP BY batch),
marks AS (SELECT batch, {chosen} - {WM_MS} AS w FROM runs),
wm AS (SELECT b.b AS batch, (SELECT max(w) FROM marks WHERE marks.batch < b.b) AS w FROM range(4) b(b)),
fan AS (SELECT *, (epoch_us(eventTime) // {S} - o) * {S} AS ws
        FROM (SELECT *, unnest(range({K})) AS o FROM bt WHERE eventTime IS NOT NULL)),
win AS (SELECT fan.* FROM fan JOIN wm USING (batch)
        WHERE epoch_us(eventTime) < ws + {W} AND (wm.w IS NULL OR ws + {W} > wm.w * 1000)),
stats AS (SELECT ip, ws, {_STATS} FROM win GROUP BY ip, ws),
{_RATED}
SELECT ip, lastEvent, {reason()} AS reason FROM rated
WHERE {FIRES} AND (ws + {W}) // 1000 <= (SELECT max(w) FROM marks))"""


STREAM_INCIDENTS_TWO_TOPICS = (_two_topics("min", "CASE WHEN a < b THEN a ELSE b END") + "\nUNION ALL\n"
                               + _two_topics("max", "greatest(a, b)"))


STREAM_BATCH_REPORT = f"""WITH {_batched(LENIENT, "lenient", "eventTime")},
fired AS (SELECT ip, ws, {FIRES} AS fires FROM (
  SELECT *, clicks + watches AS total_events,
         CASE WHEN clicks > 0 THEN watches / clicks ELSE CAST(watches AS DOUBLE) END AS rate
  FROM (SELECT ip, ws, {_STATS} FROM win GROUP BY ip, ws))),
marks AS (SELECT b.b AS batch, (SELECT max(epoch_ms(tm)) FROM bt WHERE bt.batch <= b.b) - {WM_MS} AS w
          FROM range(4) b(b)),
late AS (SELECT fan.batch, count(DISTINCT (fan.ip, ws)) AS n FROM fan JOIN wm USING (batch)
         WHERE epoch_us(tm) < ws + {W} AND ws + {W} <= wm.w * 1000 GROUP BY fan.batch),
closed AS (SELECT f.*, (SELECT min(m.batch) FROM marks m WHERE (ws + {W}) // 1000 <= m.w) AS batch FROM fired f),
held AS (SELECT m.batch, count(*) AS n FROM marks m JOIN
           (SELECT ip, ws, min(batch) AS since FROM win GROUP BY ip, ws) s
           ON s.since <= m.batch AND (ws + {W}) // 1000 > m.w GROUP BY m.batch)
SELECT CAST(m.batch AS INTEGER) AS delivery, (SELECT count(*) FROM bt WHERE bt.batch = m.batch) AS input,
       coalesce((SELECT n FROM late WHERE late.batch = m.batch), 0) AS late,
       (SELECT count(*) FROM closed WHERE fires AND closed.batch = m.batch) AS emitted,
       coalesce((SELECT n FROM held WHERE held.batch = m.batch), 0) AS state_rows
FROM marks m"""

SUSPICIOUS_WINDOWS = f"""WITH {EV},
{windows("ev")}
SELECT ip, count(*) AS windows, count(*) FILTER (WHERE {FIRES}) AS suspicious, min(rate) AS lowest_rate
FROM rated GROUP BY ip"""

BANS_OF = f"SELECT * FROM ({_current_bans(14 * 86_400)}) WHERE CAST(ip AS BIGINT) % 20 = 0"

ARCHIVE_LOOKUP = f"""WITH found AS ({INCIDENTS}),
top AS (SELECT ip FROM found GROUP BY ip ORDER BY count(*) DESC, ip LIMIT 1),
newest AS (SELECT date_trunc('day', max(lastEvent)) AS d FROM found)
SELECT 'ip' AS asked, * FROM found WHERE ip = (SELECT ip FROM top)
UNION ALL SELECT 'day', * FROM found WHERE lastEvent >= (SELECT d FROM newest)
UNION ALL SELECT 'both', * FROM found WHERE ip = (SELECT ip FROM top) AND lastEvent >= (SELECT d FROM newest)"""

SPOOL_FILE_REPORT = f"""WITH {REC},
judged AS (SELECT coalesce(s.k, -1) AS k, NOT coalesce({ACCEPTED}, false) AS bad
           FROM msg JOIN src s ON s.event_id = msg."offset")
SELECT CAST(k AS INTEGER) AS k, count(*) AS lines, count(*) FILTER (WHERE bad) AS rejects,
       CASE WHEN count(*) FILTER (WHERE bad) > 0 THEN 'error' ELSE 'finished' END AS status
FROM judged GROUP BY k"""


def oracle_sql() -> dict[str, str]:
    return {
        "window_event_stats": WINDOW_EVENT_STATS,
        "incidents": INCIDENTS,
        "incidents_sql": INCIDENTS,
        "incidents_struct": INCIDENTS,
        "incidents_formatted": INCIDENTS_FORMATTED,
        "incidents_require_action": INCIDENTS_FORMATTED,
        "incidents_nulls": _nulls("evn", fmt=False),
        "incidents_nulls_typed": _nulls("evt", fmt=True),
        "incidents_nulls_aggregator": _nulls("eva", fmt=True),
        "incidents_distinct_sorted": "SELECT DISTINCT * FROM (" + INCIDENTS
        + ") ORDER BY lastEvent, reason",
        "incidents_panes": INCIDENTS,
        "window_event_stats_panes": WINDOW_EVENT_STATS,
        "incidents_hourly_slide": INCIDENTS_HOURLY,
        "incidents_by_batch_time": INCIDENTS_BY_BATCH_TIME,
        "incidents_by_arrival": INCIDENTS_BY_ARRIVAL,
        "incidents_by_arrival_skip_old": INCIDENTS_BY_ARRIVAL_SKIP_OLD,
        "ban_records": BAN_RECORDS,
        "ban_records_ms": BAN_RECORDS_MS,
        "current_bans": CURRENT_BANS,
        "current_bans_compacted": CURRENT_BANS,
        "parse_lenient": PARSE_LENIENT,
        "parse_strict": PARSE_STRICT,
        "parse_quarantine": PARSE_QUARANTINE,
        "key_extract": KEY_EXTRACT,
        "incidents_from_messages": FROM_MESSAGES,
        "incidents_from_messages_strict": FROM_MESSAGES_STRICT,
        "incidents_from_spool_lines": FROM_SPOOL,
        "incidents_from_spool_files": FROM_SPOOL,
        "merge_partial_aggregates": MERGE_PARTIALS,
        "counter_totals": COUNTER_TOTALS,
        "stream_incidents_append": STREAM_APPEND,
        "stream_incidents_event_time": STREAM_APPEND_EVENTS,
        "stream_bans_upsert": STREAM_BANS,
        "stream_bans_rows": f"SELECT ip, period, reason, true AS in_force FROM ({FROM_MESSAGES})",
        "stream_counter": COUNTER_TOTALS,
        "stream_bans_by_arrival": STREAM_BANS_BY_ARRIVAL,
        "stream_incidents_late": STREAM_INCIDENTS_LATE,
        "stream_incidents_by_slide": STREAM_INCIDENTS_BY_SLIDE,
        "stream_open_windows": STREAM_OPEN_WINDOWS,
        "stream_incidents_distinct": STREAM_INCIDENTS_DISTINCT,
        "stream_incidents_redelivered": STREAM_INCIDENTS_REDELIVERED,
        "stream_incidents_two_topics": STREAM_INCIDENTS_TWO_TOPICS,
        "stream_batch_report": STREAM_BATCH_REPORT,
        "incidents_sql_functions": INCIDENTS,
        "suspicious_windows_sql": SUSPICIOUS_WINDOWS,
        "bans_of": BANS_OF,
        "current_bans_keyed": CURRENT_BANS,
        "incidents_from_rollup": INCIDENTS,
        "archive_lookup": ARCHIVE_LOOKUP,
        "spool_file_report": SPOOL_FILE_REPORT,
    }
