"""DuckDB SQL that answers the registered queries from the same parquet tables.

The counter tables are derived in SQL from ``events`` by the rules of FIXTURES.md,
with plain windows, ``ASOF`` joins and JSON functions, so the SQL takes other
ways than the Spark operators.
"""

from __future__ import annotations

# name -> (tables it needs, SQL)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), """
        SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k,
               event_type = 'error' AND value > 60 AS reboot
        FROM events"""),
    "epochs": (("ev",), """
        SELECT *, sum(CASE WHEN reboot THEN 1 ELSE 0 END) OVER (
            PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS epoch
        FROM ev"""),
    "counted": (("epochs",), """
        SELECT event_id, ts, user_id, event_type, k,
               CAST(sum(CASE WHEN event_type IN ('click', 'signup') THEN floor(value) ELSE 0 END)
                   OVER w AS INT) AS in_count,
               CAST(sum(CASE WHEN event_type IN ('view', 'signup') THEN floor(value) ELSE 0 END)
                   OVER w AS INT) AS out_count
        FROM epochs
        WINDOW w AS (PARTITION BY user_id, epoch ORDER BY ts, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "log": (("counted",), """
        SELECT event_id AS id, 'dev-' || user_id AS device_id,
               CASE WHEN user_id % 41 <> 0 THEN 'B' || ((user_id + CASE
                   WHEN user_id % 7 = 0 AND ts >= TIMESTAMP '2024-01-20' THEN 1 ELSE 0 END) % 10)
               END AS location,
               CASE WHEN user_id % 5 <> 0 THEN 'F' || (user_id % 3) END AS sublocation,
               in_count, out_count, CAST(100 + user_id % 50 AS INT) AS capacity,
               ts AS event_time, ts + to_minutes(k * 10) AS created_at, k, user_id
        FROM counted"""),
    "resets": (("counted",), """
        SELECT 'dev-' || user_id AS device_id, ts AS reset_time,
               in_count AS reset_in_count, out_count AS reset_out_count
        FROM counted WHERE event_type = 'purchase' AND k < 14"""),
    "log_months": (("log",), """
        SELECT * REPLACE (event_time + to_days(CASE WHEN event_time < TIMESTAMP '2024-01-11' THEN 0
            WHEN event_time < TIMESTAMP '2024-01-21' THEN 40 ELSE 80 END) AS event_time)
        FROM log"""),
    "resets_months": (("resets",), """
        SELECT * REPLACE (reset_time + to_days(CASE WHEN reset_time < TIMESTAMP '2024-01-11' THEN 0
            WHEN reset_time < TIMESTAMP '2024-01-21' THEN 40 ELSE 80 END) AS reset_time)
        FROM resets"""),
    "newest_reset": (("resets",), """
        SELECT device_id, reset_time, reset_in_count, reset_out_count FROM (
            SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY reset_time DESC,
                reset_in_count DESC, reset_out_count DESC) AS rn FROM resets) WHERE rn = 1"""),
    "sensor": (("log",), """
        SELECT CAST(user_id AS INT) AS id, 'dev-' || user_id AS device, location,
               CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 19 = 0 THEN '  '
                    ELSE '10.0.' || ((user_id // 256) % 256) || '.' || (user_id % 256) END AS ip_address,
               user_id % 3 = 0 AS is_online,
               CASE WHEN user_id % 13 <> 0 THEN seen END AS last_seen,
               CASE WHEN user_id % 17 = 0 THEN NULL WHEN user_id % 3 = 0 THEN 'Online'
                    WHEN user_id % 3 = 1 THEN 'Idle' ELSE 'Offline' END AS status
        FROM (SELECT user_id, location, max(event_time) OVER (PARTITION BY user_id) AS seen,
                     row_number() OVER (PARTITION BY user_id ORDER BY created_at, id) AS rn FROM log)
        WHERE rn = 1"""),
    "probe": (("sensor",), "SELECT device, id % 3 = 0 AS reachable FROM sensor"),
    "elements": (("log",), """
        SELECT id // 5 AS arrival, id, k, event_time,
            CASE WHEN k = 11 THEN 'null,' ELSE '' END || '{"Device":' ||
            CASE WHEN k = 3 THEN 'null' ELSE '"' || device_id || '"' END || ',"Data":' ||
            CASE WHEN k = 4 THEN 'null' WHEN k = 5 THEN '[null,' || r || ']'
                 WHEN k = 8 THEN '[' || r || ',' || r || ']' WHEN k = 18 THEN '[]'
                 ELSE '[' || r || ']' END || '}' AS element
        FROM (SELECT *,
            '{"Location":' || coalesce('"' || location || '"', 'null') ||
            ',"SubLocation":' || CASE WHEN k = 9 THEN 'null'
                ELSE coalesce('"' || sublocation || '"', 'null') END || ',' ||
            CASE WHEN k = 1 THEN '"Total_IN":"' || in_count || '",' WHEN k = 6 THEN ''
                 WHEN k = 13 THEN '"total_in":' || in_count || ','
                 ELSE '"Total_IN":' || in_count || ',' END ||
            '"Total_Out":' || CASE WHEN k = 10 THEN out_count || '.5' WHEN k = 17 THEN 'null'
                ELSE CAST(out_count AS VARCHAR) END ||
            ',"Capacity":' || CASE WHEN k = 12 THEN '3000000000'
                ELSE CAST(capacity AS VARCHAR) END || ',' ||
            CASE WHEN k = 7 THEN '' ELSE '"ipaddr":"10.0.' || ((user_id // 256) % 256) || '.' ||
                (user_id % 256) || '",' END ||
            '"TimeStamp":' || CASE WHEN k = 2 THEN '"not-a-time"' WHEN k = 14 THEN '""'
                WHEN k = 15 THEN 'null'
                WHEN k = 16 THEN strftime(event_time, '"%Y-%m-%dT%H:%M:%SZ"')
                ELSE strftime(event_time, '"%Y-%m-%dT%H:%M:%S.%f"') END || '}' AS r
            FROM log)"""),
    "payload": (("elements",), """
        SELECT arrival, CAST((dayofmonth(first_at) - 1) // 8 AS INT) AS week,
            CASE k WHEN 50 THEN body[:-2] WHEN 51 THEN '' WHEN 52 THEN '[]' WHEN 53 THEN 'null'
                WHEN 54 THEN '{"m":' || body || '}' WHEN 55 THEN body || ' x' ELSE body END AS value
        FROM (SELECT arrival, min(event_time) AS first_at, arg_min(k, id) AS k,
                     '[' || string_agg(element, ',' ORDER BY id) || ']' AS body
              FROM elements GROUP BY arrival)"""),
    "devices": (("payload",), """
        SELECT arrival, week, i, list_extract(parts, i) AS device,
               json_extract(list_extract(parts, i), '$.Data') AS data
        FROM (SELECT arrival, week, json_extract(value, '$[*]') AS parts FROM payload
              WHERE json_valid(value) AND json_type(value) = 'ARRAY'),
             LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)"""),
    "readings": (("devices",), """
        SELECT arrival, week, i, j, device, list_extract(parts, j) AS reading
        FROM (SELECT *, json_extract(data, '$[*]') AS parts FROM devices
              WHERE json_type(device) = 'OBJECT' AND json_type(data) = 'ARRAY'),
             LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS j)"""),
    "bad_messages": (("payload", "devices", "readings"), """
        SELECT arrival FROM payload WHERE value <> '' AND value <> 'null'
            AND (NOT json_valid(value) OR json_type(value) <> 'ARRAY')
        UNION SELECT arrival FROM devices WHERE json_type(device) NOT IN ('OBJECT', 'NULL')
            OR coalesce(json_type(device, '$.Device'), 'NULL') NOT IN ('VARCHAR', 'NULL')
            OR coalesce(json_type(data), 'NULL') NOT IN ('ARRAY', 'NULL')
        UNION SELECT arrival FROM readings WHERE json_type(reading) NOT IN ('OBJECT', 'NULL')
            OR len(list_filter(['$.Total_IN', '$.Total_Out', '$.Capacity'], lambda f:
                coalesce(json_type(reading, f), 'UBIGINT') NOT IN ('UBIGINT', 'BIGINT')
                OR coalesce(TRY_CAST(json_extract_string(reading, f) AS BIGINT), 0)
                    NOT BETWEEN -2147483648 AND 2147483647)) > 0
            OR len(list_filter(['$.Location', '$.SubLocation', '$.ipaddr', '$.TimeStamp'], lambda f:
                coalesce(json_type(reading, f), 'NULL') NOT IN ('VARCHAR', 'NULL'))) > 0"""),
    "decoded": (("devices", "readings", "bad_messages"), """
        SELECT arrival, week,
            CAST(row_number() OVER (PARTITION BY arrival ORDER BY i, j) - 1 AS INT) AS position,
            device_id, location, sublocation, in_count, out_count, capacity, ip_address,
            event_time, reason
        FROM (
            SELECT arrival, week, i, j, json_extract_string(device, '$.Device') AS device_id,
                json_extract_string(reading, '$.Location') AS location,
                json_extract_string(reading, '$.SubLocation') AS sublocation,
                coalesce(CAST(json_extract_string(reading, '$.Total_IN') AS INT), 0) AS in_count,
                coalesce(CAST(json_extract_string(reading, '$.Total_Out') AS INT), 0) AS out_count,
                coalesce(CAST(json_extract_string(reading, '$.Capacity') AS INT), 0) AS capacity,
                CASE WHEN json_type(reading, '$.ipaddr') IS NULL THEN ''
                     ELSE json_extract_string(reading, '$.ipaddr') END AS ip_address,
                TRY_CAST(rtrim(json_extract_string(reading, '$.TimeStamp'), 'Z') AS TIMESTAMP)
                    AS event_time,
                CASE WHEN json_type(reading) = 'NULL' THEN 'null_element'
                     WHEN json_extract_string(device, '$.Device') IS NULL THEN 'null_device'
                     WHEN TRY_CAST(rtrim(json_extract_string(reading, '$.TimeStamp'), 'Z')
                         AS TIMESTAMP) IS NULL THEN 'bad_timestamp' END AS reason
            FROM readings WHERE arrival NOT IN (SELECT arrival FROM bad_messages)
            UNION ALL
            SELECT arrival, week, i, 0, json_extract_string(device, '$.Device'), NULL, NULL, 0, 0, 0, '',
                NULL, CASE WHEN json_type(device) = 'NULL' THEN 'null_element' ELSE 'null_data' END
            FROM devices WHERE arrival NOT IN (SELECT arrival FROM bad_messages)
                AND (json_type(device) = 'NULL' OR coalesce(json_type(data), 'NULL') = 'NULL'))"""),
    "parsed": (("decoded",), """
        SELECT week, arrival, position, device_id, location, sublocation, in_count, out_count,
               capacity, ip_address, event_time, arrival * 16777216 + position AS id
        FROM decoded WHERE reason IS NULL"""),
    "kept": (("parsed",), """
        SELECT * EXCLUDE (rn, before_in, before_out) FROM (
            SELECT *, row_number() OVER w AS rn, lag(in_count) OVER w AS before_in,
                   lag(out_count) OVER w AS before_out
            FROM parsed WINDOW w AS (PARTITION BY device_id ORDER BY week, event_time, id))
        WHERE rn = 1 OR in_count <> before_in OR out_count <> before_out"""),
    "weeks": (("payload",), "SELECT DISTINCT week FROM payload"),
}

DISPLAY = """
    CASE WHEN reset_in_count IS NULL OR {0}in < reset_in_count THEN {0}in
         ELSE {0}in - reset_in_count END AS display_in,
    CASE WHEN reset_out_count IS NULL OR {0}out < reset_out_count THEN {0}out
         ELSE {0}out - reset_out_count END AS display_out"""
DISPLAY_COUNTS = """
    CASE WHEN reset_in_count IS NULL OR in_count < reset_in_count THEN in_count
         ELSE in_count - reset_in_count END AS display_in,
    CASE WHEN reset_out_count IS NULL OR out_count < reset_out_count THEN out_count
         ELSE out_count - reset_out_count END AS display_out"""
LOG_COLUMNS = (
    "id, device_id, location, sublocation, in_count, out_count, capacity, event_time, created_at"
)
SNAPSHOT = "device_id, location, sublocation, event_time, display_in, display_out"


def with_tables(body: str, *needed: str) -> str:
    """Prefix ``body`` with the CTEs it needs, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in CTES[name][0]:
            visit(other)
        if name not in order:
            order.append(name)

    for name in needed:
        visit(name)
    parts = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name][1]})" for name in order)
    return f"WITH {parts}\n{body}" if parts else body


def _newest(source: str, where: str, order: str = "created_at DESC, id DESC") -> str:
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY {order})
        AS rn FROM {source} WHERE {where}) WHERE rn = 1)"""


def _snapshot(where: str, select: str) -> str:
    return with_tables(
        f"""SELECT {select} FROM (SELECT l.*, {DISPLAY_COUNTS}
            FROM {_newest("log", "created_at >= TIMESTAMP '2024-01-11' AND " + where)} l
            LEFT JOIN newest_reset r USING (device_id))""",
        "log", "newest_reset", "sensor",
    )


def _asof(probe_time: str, op: str, log: str = "log") -> str:
    return f"""SELECT l.*, r.reset_time, r.reset_in_count, r.reset_out_count
        FROM {log} l ASOF LEFT JOIN resets r
        ON l.device_id = r.device_id AND {probe_time} {op} r.reset_time"""


def _trend(
    bucket: str,
    where: str,
    start: str,
    end: str,
    out_keys: str = "",
    monthly: bool = False,
    number: str = "BIGINT",
    source: str = "log",
) -> str:
    """``out_keys``: leading result columns; growth is per device and, if kept, location."""
    log, resets = ("log_months", "resets_months") if monthly else (source, "resets")
    group = "device_id, location" if "location" in out_keys else "device_id"
    keys = f"{out_keys}, time" if out_keys else "time"
    return with_tables(
        f"""SELECT {keys}, CAST(sum(greatest(d_in, 0)) AS {number}) AS "in",
                   CAST(sum(greatest(d_out, 0)) AS {number}) AS "out"
        FROM (SELECT {group}, time,
                CASE WHEN lag(max_in) OVER w IS NULL THEN max_in - min_in
                     ELSE max_in - lag(max_in) OVER w END AS d_in,
                CASE WHEN lag(max_out) OVER w IS NULL THEN max_out - min_out
                     ELSE max_out - lag(max_out) OVER w END AS d_out
            FROM (SELECT {group}, date_trunc('{bucket}', event_time) AS time,
                    max(display_in) AS max_in, min(display_in) AS min_in,
                    max(display_out) AS max_out, min(display_out) AS min_out
                FROM (SELECT *, {DISPLAY_COUNTS} FROM (
                    SELECT l.*, r.reset_in_count, r.reset_out_count FROM {log} l
                    ASOF LEFT JOIN {resets} r
                    ON l.device_id = r.device_id AND l.event_time >= r.reset_time))
                WHERE {where} AND event_time BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'
                GROUP BY ALL)
            WINDOW w AS (PARTITION BY {group} ORDER BY time))
        GROUP BY {keys}""",
        log, resets,
    )


def _daily(where: str) -> str:
    return with_tables(
        f"""SELECT device_id, location, sublocation, bucket_time, raw_in, raw_out, raw_inside,
                display_in, display_out, display_in - display_out AS display_inside
        FROM (SELECT m.*, greatest(raw_in - raw_out, 0) AS raw_inside, {DISPLAY.format("raw_")}
            FROM (SELECT device_id, location, sublocation,
                    date_trunc('minute', event_time) AS bucket_time,
                    max(in_count) AS raw_in, max(out_count) AS raw_out
                FROM log WHERE CAST(event_time AS DATE) = DATE '2024-01-15' AND {where}
                GROUP BY ALL) m
            ASOF LEFT JOIN resets r ON m.device_id = r.device_id
                AND m.bucket_time + INTERVAL 1 MINUTE > r.reset_time)""",
        "log", "resets",
    )


def _ledger(where: str) -> str:
    return with_tables(
        f"""SELECT device_id, TIMESTAMP '2024-02-10' AS reset_time,
                in_count AS reset_in_count, out_count AS reset_out_count
        FROM {_newest("log", "true", "event_time DESC, id DESC")} WHERE {where}""",
        "log", "sensor",
    )


LAST_DATA = "(SELECT device_id, max(created_at) AS last_data_time FROM log GROUP BY device_id)"
HEALTH = f"""(SELECT device, last_data_time,
        CASE WHEN last_data_time >= TIMESTAMP '2024-01-31' - INTERVAL 5 MINUTE THEN 'Online'
             WHEN trim(coalesce(ip_address, '')) <> '' AND reachable THEN 'Idle'
             ELSE 'Offline' END AS status
    FROM sensor LEFT JOIN {LAST_DATA} ON device = device_id LEFT JOIN probe USING (device))"""
OLD = "event_time < TIMESTAMP '2024-01-15'"
CHANGED = f"""SELECT {LOG_COLUMNS} FROM (
        SELECT *, row_number() OVER w AS rn, lag(in_count) OVER w AS before_in,
               lag(out_count) OVER w AS before_out
        FROM log WINDOW w AS (PARTITION BY device_id ORDER BY event_time, id))
    WHERE rn = 1 OR in_count <> before_in OR out_count <> before_out"""
KEPT = "id, device_id, location, sublocation, in_count, out_count, capacity, event_time"
FIRST_PLACE = """(SELECT device_id, location, ip_address FROM (SELECT *, row_number() OVER (
        PARTITION BY device_id ORDER BY arrival, position) AS rn FROM parsed) WHERE rn = 1)"""
EARLY = "(SELECT DISTINCT device_id FROM log WHERE event_time < TIMESTAMP '2024-01-02')"
DAYS = ("2024-01-05", "2024-01-25 23:59:59")
DAYS_FULL = ("2024-01-05", "2024-01-25 23:59:59.999999")
HOURS = ("2024-01-05", "2024-01-25")
MONTHS = ("2024-01-01", "2024-04-30 23:59:59")
MONTHS_FULL = ("2024-01-01", "2024-04-30 23:59:59.999999")


def oracle_sql() -> dict[str, str]:
    dev7, b7 = "device_id = 'dev-7'", "location = 'B7'"
    inside = f"{SNAPSHOT}, display_in - display_out AS inside"
    return {
        "latest_reset": with_tables("SELECT * FROM newest_reset", "newest_reset"),
        "latest_log": with_tables(
            f"SELECT {LOG_COLUMNS} FROM {_newest('log', 'true')}", "log"),
        "building_summary": _snapshot("true", """location AS building,
            CAST(sum(display_in) AS BIGINT) AS total_in, CAST(sum(display_out) AS BIGINT) AS total_out,
            CAST(sum(display_in) - sum(display_out) AS BIGINT) AS total_capacity""") + " GROUP BY location",
        "building_devices": _snapshot(b7, inside),
        "latest_devices": _snapshot(
            "device_id IN (SELECT device FROM sensor WHERE is_online)", inside),
        "device_building": with_tables(
            f"""SELECT device_id, location FROM {_newest("log", "true")}
            WHERE location IS NOT NULL AND device_id IN (SELECT device FROM sensor WHERE is_online)""",
            "log", "sensor"),
        "log_union": with_tables(f"SELECT {LOG_COLUMNS} FROM log", "log"),
        "asof_reset": with_tables(
            f"SELECT id, device_id, event_time, reset_time, reset_in_count, reset_out_count "
            f"FROM ({_asof('l.event_time', '>=')})", "log", "resets"),
        "asof_reset_strict": with_tables(
            f"SELECT id, device_id, event_time, reset_time, reset_in_count, reset_out_count FROM "
            f"({_asof('''date_trunc('minute', l.event_time) + INTERVAL 1 MINUTE''', '>')})",
            "log", "resets"),
        "asof_reset_sliced": with_tables(
            f"SELECT id, device_id, event_time, reset_time, reset_in_count, reset_out_count "
            f"FROM ({_asof('l.event_time', '>=')})", "log", "resets"),
        "asof_reset_shuffled": with_tables(
            f"SELECT id, device_id, event_time, reset_time, reset_in_count, reset_out_count "
            f"FROM ({_asof('l.event_time', '>=')})", "log", "resets"),
        "display_counts": with_tables(
            f"SELECT id, device_id, event_time, in_count, out_count, {DISPLAY_COUNTS} "
            f"FROM ({_asof('l.event_time', '>=')})", "log", "resets"),
        "sensor_trend_hour": _trend("hour", dev7, *HOURS, number="INT"),
        "sensor_trend_day": _trend("day", dev7, *DAYS, number="INT"),
        "sensor_trend_month": _trend("month", dev7, *MONTHS, monthly=True, number="INT"),
        "sensor_trend_all_hour": _trend("hour", "true", *HOURS, "device_id", number="INT"),
        "location_trend_hour": _trend("hour", b7, *HOURS),
        "location_trend_day": _trend("day", b7, *DAYS_FULL),
        "location_trend_month": _trend("month", b7, *MONTHS_FULL, monthly=True),
        "location_trend_all_day": _trend("day", "true", *DAYS_FULL, "location"),
        "daily_comparison_building": _daily(b7),
        "daily_comparison_device": _daily(dev7),
        "daily_comparison_both": _daily(f"{b7} AND {dev7}"),
        "reset_device": _ledger("device_id IN (SELECT device FROM sensor WHERE status = 'Offline')"),
        "reset_building": _ledger(
            f"device_id IN (SELECT device_id FROM log WHERE {b7})"),
        "location_devices": with_tables(f"SELECT DISTINCT device_id FROM log WHERE {b7}", "log"),
        "archive_moved": with_tables(
            f"SELECT {LOG_COLUMNS} FROM log WHERE {OLD} AND k >= 10", "log"),
        "archive_after": with_tables(f"SELECT {LOG_COLUMNS} FROM log WHERE {OLD}", "log"),
        "archived_still_live": with_tables(
            f"SELECT {LOG_COLUMNS} FROM log WHERE {OLD} AND k < 10", "log"),
        "live_after_archive": with_tables(
            f"SELECT {LOG_COLUMNS} FROM log WHERE NOT ({OLD})", "log"),
        "recent_activity": with_tables(
            f"""SELECT device_id, last_data_time >= TIMESTAMP '2024-01-30 23:55:00' AS is_active
            FROM {LAST_DATA}""", "log"),
        "last_data_time": with_tables(f"SELECT * FROM {LAST_DATA}", "log"),
        "health_status": with_tables(
            f"SELECT device, status, last_data_time FROM {HEALTH}", "log", "sensor", "probe"),
        "health_summary": with_tables(
            f"""SELECT count(*) FILTER (status = 'Online') AS online,
                count(*) FILTER (status = 'Idle') AS idle,
                count(*) FILTER (status = 'Offline') AS offline, count(*) AS total FROM {HEALTH}""",
            "log", "sensor", "probe"),
        "sensor_status_applied": with_tables(
            f"""SELECT id, device, location, ip_address, h.status = 'Online' AS is_online,
                coalesce(h.last_data_time, s.last_seen) AS last_seen, h.status
            FROM sensor s JOIN {HEALTH} h USING (device)""", "log", "sensor", "probe"),
        "sensor_status": with_tables(
            """SELECT device, coalesce(location, '') AS location, is_online, last_seen,
                coalesce(ip_address, '') AS ip_address, coalesce(status, 'Offline') AS status
            FROM sensor""", "sensor"),
        "sensor_lookup": with_tables(
            """SELECT device, coalesce(location, '') AS location, is_online, last_seen,
                coalesce(ip_address, '') AS ip_address, coalesce(status, 'Offline') AS status
            FROM sensor WHERE device = 'dev-7'""", "sensor"),
        "device_list": with_tables("SELECT device FROM sensor ORDER BY device", "sensor"),
        "location_list": with_tables("SELECT DISTINCT location FROM sensor ORDER BY 1", "sensor"),
        "role_membership": """
            SELECT c_custkey AS user_id, c_name AS username,
                   string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS roles
            FROM customer JOIN orders ON c_custkey = o_custkey
            WHERE c_acctbal > 0 GROUP BY ALL""",
        "parse_payload": with_tables(
            """SELECT arrival, position, device_id, location, sublocation, in_count, out_count,
                capacity, ip_address, event_time FROM parsed""", "parsed"),
        "parse_rejects": with_tables(
            """SELECT arrival, position, device_id, reason FROM decoded WHERE reason IS NOT NULL
            UNION ALL SELECT arrival, 0, NULL, 'bad_message' FROM bad_messages""",
            "decoded", "bad_messages"),
        "changed_only": with_tables(CHANGED, "log"),
        "changed_only_sliced": with_tables(CHANGED, "log"),
        "discovered_sensors": with_tables(
            f"""SELECT device_id AS device, location, ip_address, true AS is_online,
                TIMESTAMP '2024-02-10' AS last_seen, 'Online' AS status
            FROM {FIRST_PLACE} WHERE device_id NOT IN (SELECT device_id FROM {EARLY})""",
            "parsed", "log"),
        "discovered_sensor_ids": with_tables(
            f"""SELECT device, CAST((SELECT coalesce(max(id), -1) FROM sensor WHERE device IN (SELECT device_id FROM {EARLY}))
                    + row_number() OVER (ORDER BY substr(md5(device), 1, 2), device) AS INT) AS id
            FROM (SELECT device_id AS device FROM {FIRST_PLACE}
                WHERE device_id NOT IN (SELECT device_id FROM {EARLY}))""",
            "parsed", "log", "sensor"),
        "health_by_recency": with_tables(
            f"SELECT device, status, last_data_time FROM {HEALTH}", "log", "sensor", "probe"),
        "sensors_registered": with_tables(
            f"""SELECT coalesce(s.device, p.device_id) AS device,
                CASE WHEN s.device IS NULL THEN p.location ELSE s.location END AS location,
                CASE WHEN s.device IS NULL THEN p.ip_address ELSE s.ip_address END AS ip_address,
                p.device_id IS NOT NULL OR is_online AS is_online,
                CASE WHEN p.device_id IS NULL THEN last_seen ELSE TIMESTAMP '2024-02-10' END AS last_seen,
                CASE WHEN p.device_id IS NULL THEN status ELSE 'Online' END AS status
            FROM (SELECT * FROM sensor WHERE device IN (SELECT device_id FROM {EARLY})) s
            FULL JOIN {FIRST_PLACE} p ON s.device = p.device_id""",
            "parsed", "log", "sensor"),
        "ingest_append": with_tables(
            f"SELECT {KEPT}, TIMESTAMP '2024-02-10' AS created_at FROM kept", "kept"),
        "stream_changed_only": with_tables(
            f"SELECT {KEPT}, TIMESTAMP '2024-02-01' + to_hours(week) AS created_at FROM kept", "kept"),
        "stream_sensor_trend": _trend("hour", "true", *HOURS, "device_id", number="INT", source="kept"),
        "log_store_live": with_tables(
            f"SELECT {KEPT}, created_at FROM log_months WHERE event_time >= TIMESTAMP '2024-03-01'", "log_months"),
        "log_store_archive": with_tables(
            f"SELECT {KEPT}, created_at FROM log_months WHERE event_time < TIMESTAMP '2024-03-01'", "log_months"),
        "log_store_union": with_tables(f"SELECT {KEPT}, created_at FROM log_months", "log_months"),
        "retention_job_live": with_tables(
            f"SELECT {KEPT}, created_at FROM log_months WHERE event_time >= TIMESTAMP '2024-03-01'", "log_months"),
        "retention_job_archive": with_tables(
            f"SELECT {KEPT}, created_at FROM log_months WHERE event_time < TIMESTAMP '2024-03-01'", "log_months"),
        "stream_device_feed": with_tables(
            f"""SELECT week AS ingest_batch, {SNAPSHOT}, display_in - display_out AS inside,
                'building:' || coalesce(location, '') AS route
            FROM (SELECT l.*, {DISPLAY_COUNTS} FROM (
                    SELECT *, row_number() OVER (PARTITION BY device_id, week
                        ORDER BY event_time DESC, id DESC) AS rn FROM kept) l
                LEFT JOIN newest_reset r USING (device_id) WHERE rn = 1)""",
            "kept", "newest_reset"),
        "stream_summary_feed": with_tables(
            f"""SELECT ingest_batch, location AS building,
                CAST(sum(display_in) AS BIGINT) AS total_in, CAST(sum(display_out) AS BIGINT) AS total_out,
                CAST(sum(display_in) - sum(display_out) AS BIGINT) AS total_capacity,
                'dashboard' AS route
            FROM (SELECT l.*, {DISPLAY_COUNTS} FROM (
                    SELECT kept.*, w.week AS ingest_batch, row_number() OVER (
                        PARTITION BY w.week, device_id
                        ORDER BY kept.week DESC, event_time DESC, id DESC) AS rn
                    FROM kept JOIN weeks w ON kept.week <= w.week) l
                LEFT JOIN newest_reset r USING (device_id) WHERE rn = 1)
            GROUP BY ingest_batch, location""",
            "kept", "newest_reset", "weeks"),
    }
