"""The registered queries as DuckDB SQL, written from the definitions."""

from authweave.plans.adapters import (
    AUTH_LINES, AUTH_LOG, DUCKDB_SECONDS, PROCESS_LINES, PROCESS_LOG, REDTEAM_LINES, REDTEAM_LOG,
    WRONG_DAY,
)

# Columns and types as the definitions state them, written out here once more so that the
# SQL does not share lists with the code it checks.
AUTH_TYPES = {
    "time": "bigint", "src_user": "string", "dst_user": "string", "src_computer": "string",
    "dst_computer": "string", "auth_type": "string", "logon_type": "string",
    "auth_orientation": "string", "success": "string",
}
PROCESS_NAMES = ["time", "user", "computer", "process", "event_type"]
REDTEAM_NAMES = ["time", "user", "src_computer", "dst_computer"]
FLAG_NAMES = [
    "is_failure", "is_logon", "is_logoff", "src_is_machine_account", "dst_is_machine_account",
    "same_user", "same_computer", "cross_host",
]
CRITICAL_NAMES = ["time", "day_index", "second_of_day", "hour", "src_user", "src_computer", "dst_computer"]
CLEAN_TYPES = {
    "time": "bigint", "day_index": "int", "second_of_day": "int", "hour": "int",
    "src_user": "string", "src_user_account": "string", "src_user_domain": "string",
    "dst_user": "string", "dst_user_account": "string", "dst_user_domain": "string",
    "src_computer": "string", "dst_computer": "string", "auth_type": "string",
    "logon_type": "string", "auth_orientation": "string", "success": "string",
    "success_flag": "int", **{name: "int" for name in FLAG_NAMES},
}

WEEK_SECONDS = 7 * 86_400
ALL_SECONDS = 30 * 86_400


def _duck(text):
    for slot, value in {
        "<SEC>": DUCKDB_SECONDS, "<EVENTS>": "events", "<AUTH>": "auth_raw", "<REDTEAM>": "red_raw",
        "<PROCESS>": "proc_raw",
    }.items():
        text = text.replace(slot, value)
    return text.strip()


# Named steps; each lists the steps it needs.
STEPS = {
    "auth_raw": ([], _duck(AUTH_LOG)),
    "proc_raw": ([], _duck(PROCESS_LOG)),
    "red_raw": (["auth_raw"], _duck(REDTEAM_LOG)),
    "auth_line": (["auth_raw"], _duck(AUTH_LINES)),
    "red_line": (["red_raw"], _duck(REDTEAM_LINES)),
    "proc_line": (["proc_raw"], _duck(PROCESS_LINES)),
    "faulty_clean": (["auth_clean"], f"SELECT * REPLACE ({WRONG_DAY.strip()} AS day_index) FROM auth_clean"),
    "red": (["red_raw"], """
SELECT *, row_number() OVER (ORDER BY time, user, src_computer, dst_computer) AS redteam_id
FROM red_raw"""),
    "red10": (["red"], "SELECT * FROM red WHERE redteam_id <= 10"),
    "norm": (["auth_raw"], """
SELECT event_id, time,
  NULLIF(upper(trim(src_user)), '') AS src_user,
  COALESCE(NULLIF(upper(trim(dst_user)), ''), 'UNKNOWN') AS dst_user,
  NULLIF(upper(trim(src_computer)), '') AS src_computer,
  NULLIF(upper(trim(dst_computer)), '') AS dst_computer,
  COALESCE(NULLIF(upper(trim(auth_type)), ''), 'UNKNOWN') AS auth_type,
  COALESCE(NULLIF(upper(trim(logon_type)), ''), 'UNKNOWN') AS logon_type,
  COALESCE(NULLIF(upper(trim(auth_orientation)), ''), 'UNKNOWN') AS auth_orientation,
  COALESCE(NULLIF(upper(trim(success)), ''), 'UNKNOWN') AS success
FROM auth_raw"""),
    "kept": (["norm"], """
SELECT * FROM norm WHERE time IS NOT NULL AND src_user IS NOT NULL
  AND src_computer IS NOT NULL AND dst_computer IS NOT NULL"""),
    "parts": (["kept"], """
SELECT *,
  COALESCE(NULLIF(regexp_extract(src_user, '^([^@]+)', 1), ''), 'UNKNOWN') AS src_user_account,
  COALESCE(NULLIF(regexp_extract(src_user, '@(.+)$', 1), ''), 'UNKNOWN') AS src_user_domain,
  COALESCE(NULLIF(regexp_extract(dst_user, '^([^@]+)', 1), ''), 'UNKNOWN') AS dst_user_account,
  COALESCE(NULLIF(regexp_extract(dst_user, '@(.+)$', 1), ''), 'UNKNOWN') AS dst_user_domain,
  CAST(floor(time / 86400.0) AS INT) AS day_index,
  CAST(((time % 86400) + 86400) % 86400 AS INT) AS second_of_day,
  CASE WHEN success = 'SUCCESS' THEN 1 WHEN success IN ('FAIL', 'FAILURE') THEN 0 ELSE -1 END AS success_flag
FROM kept"""),
    "auth_clean": (["parts"], """
SELECT time, day_index, second_of_day, CAST(floor(second_of_day / 3600.0) AS INT) AS hour,
  src_user, src_user_account, src_user_domain, dst_user, dst_user_account, dst_user_domain,
  src_computer, dst_computer, auth_type, logon_type, auth_orientation, success,
  success_flag, CAST(success_flag = 0 AS INT) AS is_failure,
  CAST(auth_orientation = 'LOGON' AS INT) AS is_logon,
  CAST(auth_orientation = 'LOGOFF' AS INT) AS is_logoff,
  CAST(src_user_account LIKE '%$' AS INT) AS src_is_machine_account,
  CAST(dst_user_account LIKE '%$' AS INT) AS dst_is_machine_account,
  CAST(src_user = dst_user AS INT) AS same_user,
  CAST(src_computer = dst_computer AS INT) AS same_computer,
  CAST(src_computer <> dst_computer AS INT) AS cross_host
FROM parts"""),
    "red_norm": (["red_raw"], """
SELECT row_number() OVER (ORDER BY time, user, src_computer, dst_computer) - 1 AS event_id, time,
  upper(trim(user)) AS user, upper(trim(src_computer)) AS src_computer,
  upper(trim(dst_computer)) AS dst_computer
FROM red_raw"""),
    "preserved_all": (["red_norm", "auth_clean"], """
SELECT r.event_id, r.time, r.user, r.src_computer, r.dst_computer,
  count(a.time) AS processed_match_count, CAST(count(a.time) > 0 AS INT) AS preserved
FROM red_norm r LEFT JOIN auth_clean a ON a.time = r.time AND a.src_user = r.user
  AND a.src_computer = r.src_computer AND a.dst_computer = r.dst_computer
GROUP BY ALL"""),
    "context": (["red", "proc_raw"], """
SELECT r.redteam_id, r.time AS redteam_time, r.user AS redteam_user,
  r.src_computer AS redteam_src_computer, r.dst_computer AS redteam_dst_computer,
  p.time AS process_time, abs(p.time - r.time) AS time_difference_seconds,
  p.user AS process_user, p.computer,
  CASE WHEN p.computer = r.src_computer THEN 'source_host' ELSE 'destination_host' END AS host_role,
  p.user = r.user AS same_user_as_redteam, p.process, p.event_type
FROM proc_raw p JOIN red r
  ON abs(p.time - r.time) <= 300 AND p.computer IN (r.src_computer, r.dst_computer)"""),
    "matched": (["red", "auth_raw"], """
SELECT r.redteam_id, count(*) AS n FROM red r JOIN auth_raw a ON a.time = r.time
  AND a.src_user = r.user AND a.src_computer = r.src_computer AND a.dst_computer = r.dst_computer
GROUP BY 1"""),
    "activity": (["auth_clean"], """
SELECT src_user, day_index, count(*) AS auth_count,
  count(*) FILTER (WHERE is_failure = 1) AS failed_count,
  count(*) FILTER (WHERE success_flag = 1) AS successful_count,
  CAST(sum(cross_host) AS BIGINT) AS cross_host_count
FROM auth_clean GROUP BY 1, 2"""),
    "days": (["auth_clean"], """
SELECT src_user, dst_computer, day_index, count(*) AS auth_count,
  count(*) FILTER (WHERE is_failure = 1) AS failed_count,
  count(*) FILTER (WHERE success_flag = 1) AS successful_count,
  CAST(sum(cross_host) AS BIGINT) AS cross_host_count,
  min(time) AS first_time, max(time) AS last_time
FROM auth_clean GROUP BY 1, 2, 3"""),
    "replaced_clean": (["auth_clean"], """
SELECT * FROM auth_clean WHERE day_index >= 7 OR is_failure = 1 AND day_index <> 3"""),
    "arc": (["edge"], """
SELECT 'u' || src_user AS a, 'h' || dst_computer AS b FROM edge
UNION ALL SELECT 'h' || dst_computer, 'u' || src_user FROM edge"""),
    "host_feature": (["edge"], """
SELECT dst_computer, count(*) AS users, CAST(sum(auth_count) AS BIGINT) AS auth_count,
  round(CAST(sum(failed_count) AS DOUBLE) / sum(auth_count), 6) AS failed_share,
  round(CAST(sum(cross_host_count) AS DOUBLE) / sum(auth_count), 6) AS cross_host_share,
  max(active_days) AS most_active_days,
  round(CAST(max(auth_count) AS DOUBLE) / sum(auth_count), 6) AS largest_user_share FROM edge GROUP BY 1"""),
    "weighted": (["edge", "node"], """
SELECT u.node_id AS user_id, h.node_id AS host_id, e.dst_computer,
  e.auth_count / sqrt(CAST(sum(e.auth_count) OVER (PARTITION BY e.src_user) AS DOUBLE)
    * sum(e.auth_count) OVER (PARTITION BY e.dst_computer)) AS weight
FROM edge e
JOIN (SELECT node, row_number() OVER (ORDER BY node) - 1 AS node_id FROM node WHERE node_type = 'user') u
  ON u.node = e.src_user
JOIN (SELECT node, row_number() OVER (ORDER BY node) - 1 AS node_id FROM node WHERE node_type = 'host') h
  ON h.node = e.dst_computer"""),
    "logon": (["auth_clean"], "SELECT src_user, day_index, hour FROM auth_clean WHERE is_logon = 1"),
    "daily": (["auth_clean"], """
SELECT src_user, day_index, list(CAST(second_of_day AS BIGINT) ORDER BY second_of_day) AS v FROM auth_clean GROUP BY 1, 2"""),
    "edge": (["auth_clean"], """
SELECT src_user, dst_computer, count(*) AS auth_count,
  count(*) FILTER (WHERE is_failure = 1) AS failed_count,
  count(*) FILTER (WHERE success_flag = 1) AS successful_count,
  CAST(sum(cross_host) AS BIGINT) AS cross_host_count,
  count(DISTINCT day_index) AS active_days,
  min(time) AS first_time, max(time) AS last_time, min(day_index) AS first_day
FROM auth_clean GROUP BY 1, 2"""),
    "node": (["auth_clean"], """
SELECT node_type, node, count(*) FILTER (WHERE source) AS as_source,
  count(*) FILTER (WHERE NOT source) AS as_destination
FROM (SELECT 'user' AS node_type, src_user AS node, true AS source FROM auth_clean
      UNION ALL SELECT 'user', dst_user, false FROM auth_clean WHERE dst_user <> 'UNKNOWN'
      UNION ALL SELECT 'host', src_computer, true FROM auth_clean
      UNION ALL SELECT 'host', dst_computer, false FROM auth_clean) e
GROUP BY 1, 2"""),
    "score": (["edge"], """
SELECT e.*, round(1 - e.auth_count / CAST(t.total AS DOUBLE), 6) AS score
FROM edge e JOIN (SELECT src_user, sum(auth_count) AS total FROM edge GROUP BY 1) t USING (src_user)"""),
    "threshold": (["score"], """
SELECT min(score) AS threshold, any_value(total) AS scored_rows
FROM (SELECT score, count(*) OVER () AS total, row_number() OVER (ORDER BY score) AS position FROM score) s
WHERE position >= ceil(CAST(0.95 AS DOUBLE) * total)"""),
    "flagged": (["score", "threshold"], """
SELECT s.*, CAST(s.score >= t.threshold AS INT) AS flagged FROM score s, threshold t"""),
    "alert": (["flagged"], """
SELECT first_time AS time, src_user AS user, dst_computer, score, auth_count, failed_count, cross_host_count
FROM flagged WHERE flagged = 1"""),
    "evidence": (["alert", "auth_clean", "proc_raw"], """
SELECT user, dst_computer, count(*) AS process_events,
  count(*) FILTER (WHERE process_user = user) AS same_user_process_events,
  count(DISTINCT process) AS distinct_processes,
  min(process_time) AS first_process_time, max(process_time) AS last_process_time
FROM (SELECT DISTINCT a.user, a.dst_computer, p.id, p.process, upper(trim(p.user)) AS process_user, p.time AS process_time
      FROM alert a JOIN auth_clean c ON c.src_user = a.user AND c.dst_computer = a.dst_computer
      JOIN (SELECT *, row_number() OVER () AS id FROM proc_raw) p
        ON upper(trim(p.computer)) IN (c.src_computer, c.dst_computer) AND abs(p.time - c.time) <= 300) near
GROUP BY 1, 2"""),
    "triaged": (["alert", "evidence"], """
SELECT row_number() OVER (ORDER BY risk DESC, score DESC, user, dst_computer) AS priority,
  CASE risk WHEN 4 THEN 'critical' WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS severity, *
FROM (SELECT a.*, coalesce(e.process_events, 0) AS process_events,
        coalesce(e.same_user_process_events, 0) AS same_user_process_events,
        coalesce(e.distinct_processes, 0) AS distinct_processes, e.first_process_time, e.last_process_time,
        CAST(failed_count > 0 AS INT) + CAST(cross_host_count > 0 AS INT)
          + CAST(coalesce(e.process_events, 0) > 0 AS INT)
          + CAST(coalesce(e.same_user_process_events, 0) > 0 AS INT) AS risk
      FROM alert a LEFT JOIN evidence e USING (user, dst_computer)) r"""),
}


def _needed(names, seen):
    for name in names:
        if name not in seen:
            _needed(STEPS[name][0], seen)
            seen.append(name)
    return seen


def _sql(steps, text):
    names = _needed(steps.split(), [])
    return "WITH " + ",\n".join(f"{n} AS ({STEPS[n][1]})" for n in names) + "\n" + text.strip()


def _all(step):
    return _sql(step, f"SELECT * FROM {step}")


def _missing(step, names):
    return _sql(step, "SELECT " + ", ".join(
        f"count(*) FILTER (WHERE {n} IS NULL) AS {n}" for n in names) + f" FROM {step}")


def _entities(step, names, null_counts):
    def one(name):
        rows = f"SELECT DISTINCT {name} FROM {step}" + ("" if null_counts else f" WHERE {name} IS NOT NULL")
        return f"(SELECT count(*) FROM ({rows}) d) AS unique_{name}"
    return _sql(step, "SELECT " + ", ".join(one(n) for n in names))


def _frequency(step, name, limit=None):
    cut = f" ORDER BY rows DESC, {name} NULLS LAST LIMIT {limit}" if limit else ""
    return _sql(step, f"SELECT {name}, count(*) AS rows FROM {step} GROUP BY 1{cut}")


def _staging(step, seconds, bad="time IS NULL", time="time"):
    inside = f"NOT ({bad}) AND {time} < {seconds}"
    return f"""SELECT count(*) FILTER (WHERE {inside}) AS total_valid_rows,
  count(*) FILTER (WHERE {bad}) AS malformed_rows,
  min({time}) FILTER (WHERE {inside}) AS minimum_timestamp,
  max({time}) FILTER (WHERE {inside}) AS maximum_timestamp,
  {seconds // 86_400} AS number_of_days, CAST({seconds} AS BIGINT) AS cutoff_seconds FROM {step}"""


def _integrity(days, table="auth_clean"):
    measures = ["count(*) AS processed_rows"]
    for name in ("time", "day_index", "second_of_day", "hour"):
        measures += [f"min({name}) AS minimum_{name}", f"max({name}) AS maximum_{name}"]
    faults = {f"null_{n}": f"{n} IS NULL" for n in CRITICAL_NAMES}
    faults |= {f"invalid_{n}": f"{n} IS NULL OR {n} NOT IN (0, 1)" for n in FLAG_NAMES}
    faults |= {
        "invalid_success_flag": "success_flag IS NULL OR success_flag NOT IN (-1, 0, 1)",
        "invalid_day_index": f"day_index < 0 OR day_index >= {days}",
        "invalid_second_of_day": "second_of_day < 0 OR second_of_day >= 86400",
        "invalid_hour": "hour < 0 OR hour > 23",
        "invalid_host_relationship": "same_computer + cross_host <> 1",
        "failure_flag_mismatch_1": "success_flag = 0 AND is_failure <> 1",
        "failure_flag_mismatch_2": "success_flag <> 0 AND is_failure <> 0",
        "simultaneous_logon_logoff": "is_logon = 1 AND is_logoff = 1",
        "day_time_mismatch": "day_index <> floor(time / 86400.0)",
    }
    measures += [f"count(*) FILTER (WHERE {rule}) AS {n}" for n, rule in faults.items()]
    return "SELECT " + ", ".join(measures) + f" FROM {table}"


def _schema_rows():
    duck = {"bigint": "BIGINT", "int": "INT", "string": "VARCHAR"}
    expected = CLEAN_TYPES
    actual = {"event_id": "bigint", **AUTH_TYPES}

    def row(name):
        e, a = expected.get(name), actual.get(name)
        status = "missing" if a is None else "unexpected" if e is None else "ok" if a == e else "type_mismatch"
        quoted = [f"'{t}'" if t else "CAST(NULL AS VARCHAR)" for t in (e, a)]
        count = f"(SELECT count({name}) FROM auth_raw)" if a else "CAST(0 AS BIGINT)"
        return (f"SELECT '{name}' AS \"column\", {quoted[0]} AS expected, {quoted[1]} AS actual, "
                f"'{status}' AS status, {count} AS \"values\"")
    assert set(expected.values()) <= set(duck)
    return _sql("auth_raw", " UNION ALL ".join(row(n) for n in {**expected, **actual}))


def _all_zero(names):
    return " AND ".join(f"i.{n} = 0" for n in names)


def _checks(table="auth_clean", preserved=None):
    nulls = [f"null_{n}" for n in CRITICAL_NAMES]
    binary = [f"invalid_{n}" for n in [*FLAG_NAMES, "success_flag"]]
    ranges = ["invalid_day_index", "invalid_second_of_day", "invalid_hour"]
    logic = ["invalid_host_relationship", "failure_flag_mismatch_1",
             "failure_flag_mismatch_2", "simultaneous_logon_logoff", "day_time_mismatch"]
    rules = {
        "physical_output": f"(SELECT count(DISTINCT day_index) FROM {table} WHERE day_index BETWEEN 0 AND 29) = 30",
        "schema": "true",
        "day_coverage": f"(SELECT list(DISTINCT day_index ORDER BY day_index) FILTER (WHERE day_index IS NOT NULL) FROM {table}) = range(0, 30)",
        "row_integrity": "i.processed_rows > 0 AND i.processed_rows <= "
                         f"(SELECT count(*) FROM auth_raw WHERE time < {ALL_SECONDS})",
        "critical_nulls": _all_zero(nulls),
        "binary_fields": _all_zero(binary),
        "temporal_ranges": _all_zero(ranges),
        "logical_consistency": _all_zero(logic),
        "redteam_preservation": preserved or "(SELECT count(*) > 0 AND min(preserved) = 1 FROM preserved_all "
                                f"WHERE time < {ALL_SECONDS})",
    }
    wide = ", ".join(f"{rule} AS {name}" for name, rule in rules.items())
    rows = [f"SELECT '{n}' AS \"check\", {n} AS passed FROM w" for n in rules]
    rows.append("SELECT 'overall', " + " AND ".join(rules) + " FROM w")
    return _sql(f"preserved_all {table}", f"""
SELECT * FROM (WITH i AS ({_integrity(30, table)}), w AS (SELECT {wide} FROM i)
{' UNION ALL '.join(rows)}) checks""")


TRIAGE_COLUMNS = [
    "priority", "severity", "risk", "time", "user", "dst_computer", "score",
    "auth_count", "failed_count", "cross_host_count", "process_events",
    "same_user_process_events", "distinct_processes", "first_process_time", "last_process_time",
]
AUTH_COLUMNS = ", ".join(AUTH_TYPES)
PAIRS_10 = "SELECT count(*) FROM context WHERE redteam_id <= 10"


RAW_MATCH = """
SELECT r.redteam_id, a.time AS redteam_time, r.user AS redteam_user, a.src_user, a.dst_user,
  a.src_computer, a.dst_computer, a.auth_type, a.logon_type, a.auth_orientation, a.success
FROM red r JOIN auth_raw a ON a.time = r.time AND a.src_user = r.user
  AND a.src_computer = r.src_computer AND a.dst_computer = r.dst_computer"""


HOUR_DRIFT = """
SELECT src_user, day_index, CAST(sum(a) AS BIGINT) AS logons, CAST(count(*) FILTER (WHERE a > 0) AS INT) AS active_hours,
  round(sum(CASE WHEN p > 0 THEN -p * log2(p) ELSE 0 END), 6) AS entropy,
  CAST(coalesce(sum(b), 0) AS BIGINT) AS baseline_logons,
  CASE WHEN sum(b) > 0 THEN round(sqrt(greatest(sum(CASE WHEN p + q > 0 THEN -(p + q) / 2 * log2((p + q) / 2) ELSE 0 END)
    - (sum(CASE WHEN p > 0 THEN -p * log2(p) ELSE 0 END) + sum(CASE WHEN q > 0 THEN -q * log2(q) ELSE 0 END)) / 2, 0)), 6)
  END AS js_distance
FROM (SELECT *, a / sum(a) OVER u AS p, b / sum(b) OVER u AS q
      FROM (SELECT d.src_user, d.day_index, h.hour,
              (SELECT count(*) FROM logon l WHERE l.src_user = d.src_user AND l.day_index = d.day_index AND l.hour = h.hour) AS a,
              (SELECT count(*) FROM logon l WHERE l.src_user = d.src_user
                AND l.day_index BETWEEN d.day_index - 7 AND d.day_index - 1 AND l.hour = h.hour) AS b
            FROM (SELECT DISTINCT src_user, day_index FROM logon) d, range(0, 24) h(hour)) c
      WINDOW u AS (PARTITION BY src_user, day_index)) s
GROUP BY 1, 2"""

# A quantile is the value at place ceil(rank * n) of the sorted values.
ROBUST = """
SELECT src_user, day_index, n, m[1] AS median, CAST(coalesce(len(b), 0) AS BIGINT) AS baseline_n,
  b[CAST(ceil(0.25 * len(b)) AS INT)] AS baseline_p25, b[CAST(ceil(0.5 * len(b)) AS INT)] AS baseline_median,
  b[CAST(ceil(0.75 * len(b)) AS INT)] AS baseline_p75,
  b[CAST(ceil(0.75 * len(b)) AS INT)] - b[CAST(ceil(0.25 * len(b)) AS INT)] AS baseline_spread,
  round(CAST(m[1] - b[CAST(ceil(0.5 * len(b)) AS INT)] AS DOUBLE)
    / nullif(b[CAST(ceil(0.75 * len(b)) AS INT)] - b[CAST(ceil(0.25 * len(b)) AS INT)], 0), 6) AS deviation,
  true AS exact
FROM (SELECT o.src_user, o.day_index, len(o.v) AS n, o.v[CAST(ceil(0.5 * len(o.v)) AS INT):] AS m,
        list_sort(flatten(list(e.v) FILTER (WHERE e.v IS NOT NULL))) AS b
      FROM daily o LEFT JOIN daily e ON e.src_user = o.src_user AND e.day_index BETWEEN o.day_index - 7 AND o.day_index - 1
      GROUP BY o.src_user, o.day_index, o.v) q"""

TRAILING = """
SELECT d.src_user, d.day_index, count(DISTINCT e.dst_computer) FILTER (WHERE e.day_index = d.day_index) AS hosts,
  count(DISTINCT e.dst_computer) AS trailing_hosts
FROM (SELECT DISTINCT src_user, day_index FROM days) d
JOIN days e ON e.src_user = d.src_user AND e.day_index BETWEEN d.day_index - 6 AND d.day_index
GROUP BY 1, 2"""


INCIDENTS = """
SELECT user, any_value(incident_first) AS first_time, any_value(incident_last) AS last_time, CAST(part AS INT) AS part,
  any_value(alerts) AS alerts, any_value(worst) AS worst_score, CAST(any_value(auths) AS BIGINT) AS auth_count,
  CAST(any_value(fails) AS BIGINT) AS failed_count, string_agg(time || '@' || dst_computer, ' ' ORDER BY time, dst_computer, score) AS listed
FROM (SELECT *, min(time) OVER i AS incident_first, max(time) OVER i AS incident_last, count(*) OVER i AS alerts,
        max(score) OVER i AS worst, sum(auth_count) OVER i AS auths, sum(failed_count) OVER i AS fails,
        (row_number() OVER (PARTITION BY user, island ORDER BY time, dst_computer, score) - 1) // 3 AS part
      FROM (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY user ORDER BY time, dst_computer ROWS UNBOUNDED PRECEDING) AS island
            FROM (SELECT *, coalesce(time - lag(time) OVER (PARTITION BY user ORDER BY time, dst_computer) > 21600, true) AS fresh
                  FROM alert) s) g
      WINDOW i AS (PARTITION BY user, island)) p
GROUP BY user, island, part"""

# Core numbers by taking nodes away: at each k, as long as there is one, all nodes with fewer
# than k neighbours left go; a node's core number is the last k that it has survived.
CORES = """
, nodes AS (SELECT a AS node, count(*) AS degree FROM arc GROUP BY 1),
peeled AS (
  SELECT 1 AS step, 1 AS k, node, 0 AS core, false AS gone FROM nodes
  UNION ALL
  SELECT step + 1, CASE WHEN going THEN k ELSE k + 1 END, node, CASE WHEN going THEN core ELSE k END, false
  FROM (SELECT p.*, left_over < k AS out_now, bool_or(left_over < k) OVER () AS going
        FROM (SELECT p.step, p.k, p.node, p.core,
                (SELECT count(*) FROM arc x JOIN peeled q ON q.node = x.b WHERE x.a = p.node) AS left_over
              FROM peeled p) p) t
  WHERE NOT out_now)
SELECT n.node_type, n.node, coalesce(d.degree, 0) AS degree, CAST(coalesce(c.core, 0) AS BIGINT) AS core
FROM node n LEFT JOIN nodes d ON d.node = left(n.node_type, 1) || n.node
LEFT JOIN (SELECT node, max(core) AS core FROM peeled GROUP BY 1) c ON c.node = d.node"""


def oracle_sql() -> dict[str, str]:
    return {
        "daily_overview": _sql("auth_clean", """
SELECT day_index, count(*) AS rows, CAST(sum(is_failure) AS BIGINT) AS failures,
  CAST(sum(cross_host) AS BIGINT) AS cross_host_rows FROM auth_clean GROUP BY 1"""),
        "auth_clean": _all("auth_clean"),
        "norm_fields": _all("norm"),
        "critical_filter": _sql("kept", """
SELECT event_id, time, src_user, dst_user, src_computer, dst_computer FROM kept"""),
        "window_filter": _sql("auth_raw", f"SELECT * FROM auth_raw WHERE time < {WEEK_SECONDS}"),
        "time_parts": _sql("auth_raw", """
SELECT event_id, time, CAST(floor(time / 86400.0) AS INT) AS day_index,
  CAST(time % 86400 AS INT) AS second_of_day,
  CAST(floor(time % 86400 / 3600.0) AS INT) AS hour
FROM auth_raw WHERE time IS NOT NULL"""),
        "user_parts": _sql("parts", """
SELECT event_id, src_user, src_user_account, src_user_domain,
  dst_user, dst_user_account, dst_user_domain FROM parts"""),
        "result_flags": _sql("norm", """
SELECT event_id, success, auth_orientation,
  CASE WHEN success = 'SUCCESS' THEN 1 WHEN success IN ('FAIL', 'FAILURE') THEN 0 ELSE -1 END AS success_flag,
  CAST(success IN ('FAIL', 'FAILURE') AS INT) AS is_failure,
  CAST(auth_orientation = 'LOGON' AS INT) AS is_logon,
  CAST(auth_orientation = 'LOGOFF' AS INT) AS is_logoff FROM norm"""),
        "account_flags": _sql("parts", """
SELECT event_id, src_user_account, dst_user_account,
  CAST(right(src_user_account, 1) = '$' AS INT) AS src_is_machine_account,
  CAST(right(dst_user_account, 1) = '$' AS INT) AS dst_is_machine_account FROM parts"""),
        "relation_flags": _sql("kept", """
SELECT event_id, CAST(src_user = dst_user AS INT) AS same_user,
  CAST(src_computer = dst_computer AS INT) AS same_computer,
  CAST(src_computer <> dst_computer AS INT) AS cross_host FROM kept"""),
        "auth_missing": _missing("auth_raw", AUTH_TYPES),
        "proc_missing": _missing("proc_raw", PROCESS_NAMES),
        "redteam_missing": _missing("red_raw", REDTEAM_NAMES),
        "auth_entities": _entities(
            "auth_raw", ["src_user", "dst_user", "src_computer", "dst_computer"], True),
        "proc_entities": _entities("proc_raw", ["user", "computer", "process"], True),
        "redteam_entities": _entities("red_raw", REDTEAM_NAMES[1:], False),
        "dist_success": _frequency("auth_raw", "success"),
        "dist_auth_type": _frequency("auth_raw", "auth_type"),
        "dist_logon_type": _frequency("auth_raw", "logon_type"),
        "dist_event_type": _frequency("proc_raw", "event_type"),
        "top_processes": _frequency("proc_raw", "process", 15),
        "top_users": _frequency("proc_raw", "user", 10),
        "top_computers": _frequency("proc_raw", "computer", 10),
        "heavy_processes": _frequency("proc_raw", "process", 15),
        "heavy_users": _frequency("proc_raw", "user", 10),
        "heavy_computers": _frequency("proc_raw", "computer", 10),
        "time_range": _sql("auth_raw proc_raw red_raw", """
SELECT 'auth' AS log, min(time) AS minimum_timestamp, max(time) AS maximum_timestamp FROM auth_raw
UNION ALL SELECT 'process', min(time), max(time) FROM proc_raw
UNION ALL SELECT 'redteam', min(time), max(time) FROM red_raw"""),
        "profile_sample": _sql("auth_raw", f"""
SELECT {AUTH_COLUMNS} FROM auth_raw ORDER BY time NULLS LAST, src_user NULLS LAST, dst_user NULLS LAST,
  src_computer NULLS LAST, dst_computer NULLS LAST, auth_type NULLS LAST, logon_type NULLS LAST,
  auth_orientation NULLS LAST, success NULLS LAST LIMIT 50000"""),
        "profile_sample_cut": _sql("auth_raw", f"""
SELECT {AUTH_COLUMNS} FROM auth_raw ORDER BY time NULLS LAST, src_user NULLS LAST, dst_user NULLS LAST,
  src_computer NULLS LAST, dst_computer NULLS LAST, auth_type NULLS LAST, logon_type NULLS LAST,
  auth_orientation NULLS LAST, success NULLS LAST LIMIT 500"""),
        "process_from_csv": _sql("proc_line", """
SELECT CAST(f[1] AS BIGINT) AS time, NULLIF(f[2], '?') AS user, NULLIF(f[3], '?') AS computer,
  NULLIF(f[4], '?') AS process, NULLIF(f[5], '?') AS event_type
FROM (SELECT string_split(value, ',') AS f FROM proc_line) s
WHERE len(f) = 5 AND TRY_CAST(f[1] AS BIGINT) IS NOT NULL"""),
        "redteam_malformed_lines": _sql("red_line", """
SELECT line_number, value AS content
FROM (SELECT value, row_number() OVER (ORDER BY value) AS line_number FROM red_line) n
WHERE len(string_split(value, ',')) <> 4"""),
        "staged_days_report": _sql("auth_line", f"""
SELECT CAST(d AS INT) AS day_index, count(l.time) AS rows
FROM range(0, 30) r(d) LEFT JOIN (
  SELECT TRY_CAST(split_part(value, ',', 1) AS BIGINT) AS time FROM auth_line
  WHERE len(string_split(value, ',')) = 9) l ON floor(l.time / 86400.0) = d AND l.time < {ALL_SECONDS}
GROUP BY d"""),
        "report_roundtrip": _sql("auth_raw", "SELECT * REPLACE (CAST(number_of_days AS BIGINT) AS number_of_days) FROM ("
                                 + _staging("auth_raw", WEEK_SECONDS) + ") r"),
        "report_presence": "SELECT 'written' AS report, true AS found UNION ALL SELECT 'absent', false",
        "validation_faults": _checks("faulty_clean", "true"),
        "kept_measures": _sql("replaced_clean", _integrity(30, "replaced_clean")),
        "kept_validation": _checks("replaced_clean", "true"),
        "kept_output": _sql("auth_clean", "SELECT day_index, count(*) AS rows FROM auth_clean GROUP BY 1"),
        "absent_days": _sql("auth_clean", """
SELECT CAST(d AS INT) AS day_index FROM range(0, 10) r(d)
WHERE d NOT IN (SELECT day_index FROM auth_clean WHERE day_index < 7 AND day_index <> 3)"""),
        "day_files": _sql("auth_clean", """
SELECT DISTINCT day_index, true AS has_files, true AS has_bytes FROM auth_clean"""),
        "match_csv_roundtrip": _sql("red auth_raw", RAW_MATCH),
        "context_csv_roundtrip": _all("context"),
        "preservation_csv_roundtrip": _sql(
            "preserved_all", f"SELECT * FROM preserved_all WHERE time < {WEEK_SECONDS}"),
        "auth_sample_csv": _sql("auth_raw", f"SELECT {AUTH_COLUMNS} FROM auth_raw ORDER BY "
                                + ", ".join(f"{n} NULLS FIRST" for n in AUTH_TYPES) + " LIMIT 100"),
        "process_sample_csv": _sql("proc_raw", "SELECT * FROM proc_raw ORDER BY "
                                   + ", ".join(f"{n} NULLS FIRST" for n in PROCESS_NAMES) + " LIMIT 100"),
        "first_rows": _sql("proc_raw", """
SELECT * FROM proc_raw ORDER BY time, user, computer, process, event_type LIMIT 10"""),
        "staging_counts": _sql("auth_raw", f"""
SELECT count(*) FILTER (WHERE time < {WEEK_SECONDS}) AS total_valid_rows,
  count(*) FILTER (WHERE time IS NULL) AS malformed_rows FROM auth_raw"""),
        "staging_report": _sql("auth_raw", _staging("auth_raw", WEEK_SECONDS)),
        "staging_from_csv": _sql("auth_line", _staging(
            "(SELECT split_part(value, ',', 1) AS head, "
            "length(value) - length(replace(value, ',', '')) AS commas FROM auth_line) l",
            ALL_SECONDS, "commas <> 8 OR TRY_CAST(head AS BIGINT) IS NULL", "TRY_CAST(head AS BIGINT)")),
        "redteam_malformed": _sql("red_line", """
SELECT count(*) FILTER (WHERE commas = 3) AS total_valid_events,
  count(*) FILTER (WHERE commas = 3 AND TRY_CAST(head AS BIGINT) IS NULL) AS missing_time,
  count(*) FILTER (WHERE commas <> 3) AS malformed_rows
FROM (SELECT split_part(value, ',', 1) AS head,
        length(value) - length(replace(value, ',', '')) AS commas FROM red_line) l"""),
        "rows_per_day": _sql("auth_clean", "SELECT day_index, count(*) AS rows FROM auth_clean GROUP BY 1"),
        "scan_counts": _sql("auth_raw proc_raw red_raw", """
SELECT (SELECT count(*) FILTER (WHERE time <= m) + CAST(max(time) > m AS INT)
        FROM auth_raw, (SELECT max(time) AS m FROM red_raw) l WHERE time IS NOT NULL GROUP BY m) AS auth_rows_scanned,
  (SELECT count(*) FILTER (WHERE time <= m) + CAST(max(time) > m AS INT)
        FROM proc_raw, (SELECT max(time) + 300 AS m FROM red_raw) l WHERE time IS NOT NULL GROUP BY m) AS process_rows_scanned"""),
        "first_redteam": _sql("red10", "SELECT redteam_id, time, user, src_computer, dst_computer FROM red10"),
        "raw_match": _sql("red auth_raw", RAW_MATCH),
        "match_count": _all("matched"),
        "match_rate": _sql("red matched", """
SELECT count(*) AS redteam_events_tested, count(m.n) AS redteam_events_with_exact_auth_match,
  round(count(m.n) * 100.0 / count(*), 2) AS exact_auth_match_rate_percent
FROM red LEFT JOIN matched m USING (redteam_id)"""),
        "unmatched_redteam": _sql("red matched", """
SELECT redteam_id, time, user, src_computer, dst_computer FROM red
WHERE redteam_id NOT IN (SELECT redteam_id FROM matched)"""),
        "redteam_preservation": _sql("preserved_all", f"SELECT * FROM preserved_all WHERE time < {WEEK_SECONDS}"),
        "preservation_summary": _sql("preserved_all", f"""
SELECT count(*) AS events_in_window, CAST(sum(preserved) AS BIGINT) AS events_preserved,
  round(sum(preserved) / count(*) * 100, 6) AS preservation_rate_percent,
  count(*) > 0 AND sum(preserved) = count(*) AS pass
FROM preserved_all WHERE time < {WEEK_SECONDS}"""),
        "process_context": _all("context"),
        "context_summary": _sql("context", """
SELECT count(*) AS process_context_events_found,
  count(*) FILTER (WHERE same_user_as_redteam) AS same_user_process_context_events,
  300 AS process_context_window_seconds FROM context"""),
        "cross_dataset_report": _sql("red10 matched context auth_raw proc_raw", f"""
SELECT count(*) AS redteam_events_tested, count(m.n) AS redteam_events_with_exact_auth_match,
  round(count(m.n) * 100.0 / count(*), 2) AS exact_auth_match_rate_percent,
  coalesce(string_agg(CAST(r.redteam_id AS VARCHAR), ',' ORDER BY r.redteam_id) FILTER (WHERE m.n IS NULL), '') AS unmatched_redteam_ids,
  (SELECT count(*) FROM auth_raw WHERE time <= max(r.time))
    + CAST((SELECT max(time) FROM auth_raw) > max(r.time) AS INT) AS auth_rows_scanned,
  (SELECT count(*) FROM proc_raw WHERE time <= max(r.time) + 300)
    + CAST((SELECT max(time) FROM proc_raw) > max(r.time) + 300 AS INT) AS process_rows_scanned,
  ({PAIRS_10}) AS process_context_events_found,
  ({PAIRS_10} AND same_user_as_redteam) AS same_user_process_context_events,
  300 AS process_context_window_seconds
FROM red10 r LEFT JOIN matched m USING (redteam_id)"""),
        "integrity_report": _sql("auth_clean", _integrity(30)),
        "schema_diff": _schema_rows(),
        "daily_retention": _sql("auth_raw auth_clean", f"""
SELECT d.day_index, coalesce(s.n, 0) AS staged_rows, coalesce(p.n, 0) AS processed_rows,
  coalesce(s.n, 0) - coalesce(p.n, 0) AS removed_rows,
  round(coalesce(p.n, 0) / CAST(s.n AS DOUBLE) * 100, 6) AS retention_rate_percent
FROM (SELECT CAST(unnest(range(0, 30)) AS INT) AS day_index) d
LEFT JOIN (SELECT CAST(floor(time / 86400.0) AS INT) AS day_index, count(*) AS n FROM auth_raw
           WHERE time < {ALL_SECONDS} GROUP BY 1) s USING (day_index)
LEFT JOIN (SELECT day_index, count(*) AS n FROM auth_clean GROUP BY 1) p USING (day_index)"""),
        "retention": _sql("auth_raw auth_clean", f"""
SELECT s.n AS staged_rows, p.n AS processed_rows, s.n - p.n AS removed_rows,
  round(p.n / CAST(s.n AS DOUBLE) * 100, 6) AS retention_rate_percent
FROM (SELECT count(*) AS n FROM auth_raw WHERE time < {ALL_SECONDS}) s,
  (SELECT count(*) AS n FROM auth_clean) p"""),
        "validation_checks": _checks(),
        "csv_roundtrip": _sql("auth_raw", f"""
SELECT time, src_user, dst_user, src_computer, dst_computer, auth_type, logon_type, auth_orientation,
  success, CAST(floor(time / 86400.0) AS INT) AS day_index
FROM auth_raw WHERE time < {ALL_SECONDS}"""),
        "parquet_roundtrip": _all("auth_clean"),
        "clean_week": _sql("auth_clean", "SELECT * FROM auth_clean WHERE day_index BETWEEN 0 AND 6"),
        "day_replacement": _sql("auth_clean", """
SELECT day_index, count(*) AS rows FROM auth_clean
WHERE day_index >= 7 OR is_failure = 1 AND day_index <> 3 GROUP BY 1"""),
        "redteam_sample": _sql("red", """
SELECT time, user, src_computer, dst_computer FROM red WHERE redteam_id <= 20"""),
        "streamed_clean": _sql("auth_clean", f"SELECT * FROM auth_clean WHERE time < {ALL_SECONDS}"),
        "streamed_contacts": _sql("auth_clean", f"""
SELECT src_user, dst_computer, min(time) AS first_time, min(day_index) AS first_day
FROM auth_clean WHERE time < {ALL_SECONDS} GROUP BY 1, 2"""),
        "user_activity": _all("activity"),
        "user_host_history": _sql("days", """
SELECT src_user, dst_computer, day_index, auth_count,
  CAST(coalesce(sum(auth_count) OVER (PARTITION BY src_user, dst_computer ORDER BY day_index
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS earlier_count FROM days"""),
        "unique_hosts": _sql("auth_clean", """
SELECT src_user, day_index, count(DISTINCT dst_computer) AS unique_hosts FROM auth_clean GROUP BY 1, 2"""),
        "first_contacts": _sql("auth_clean", """
SELECT src_user, dst_computer, min(time) AS first_time, min(day_index) AS first_day
FROM auth_clean GROUP BY 1, 2"""),
        "new_hosts": _sql("auth_clean", """
SELECT src_user, day_index, count(*) AS new_hosts
FROM (SELECT src_user, dst_computer, min(day_index) AS day_index FROM auth_clean GROUP BY 1, 2) f
GROUP BY 1, 2"""),
        "cross_host_activity": _sql("activity", """
SELECT src_user, day_index, auth_count, cross_host_count,
  round(cross_host_count / CAST(auth_count AS DOUBLE), 6) AS cross_host_share FROM activity"""),
        "login_hours": _sql("auth_clean", """
SELECT src_user, hour, count(*) AS logons,
  round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY src_user) AS DOUBLE), 6) AS share
FROM auth_clean WHERE is_logon = 1 GROUP BY 1, 2"""),
        "baselines": _sql("activity", """
SELECT src_user, day_index, auth_count, n AS baseline_days,
  round(mean, 6) AS baseline_mean, round(sd, 6) AS baseline_stddev,
  round((auth_count - mean) / nullif(sd, 0), 6) AS z_score
FROM (SELECT *, CAST(total AS DOUBLE) / nullif(n, 0) AS mean,
        sqrt(CAST(n * squares - total * total AS DOUBLE) / nullif(n * (n - 1), 0)) AS sd
      FROM (SELECT src_user, day_index, auth_count, count(*) OVER w AS n,
              CAST(sum(auth_count) OVER w AS BIGINT) AS total,
              CAST(sum(auth_count * auth_count) OVER w AS HUGEINT) AS squares
            FROM activity WINDOW w AS (PARTITION BY src_user ORDER BY day_index
              RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING)) s) d"""),
        "hour_drift": _sql("logon", HOUR_DRIFT),
        "robust_baselines": _sql("daily", ROBUST),
        "exact_baselines": _sql("daily", ROBUST),
        "trailing_hosts": _sql("days", TRAILING),
        "trailing_hosts_estimated": _sql("days", TRAILING),
        "redteam_labels": _sql("red_norm auth_clean", """
SELECT time, src_user, src_computer, dst_computer,
  CAST((time, src_user, src_computer, dst_computer) IN
    (SELECT (time, user, src_computer, dst_computer) FROM red_norm) AS INT) AS label FROM auth_clean"""),
        "graph_nodes": _all("node"),
        "graph_edges": _all("edge"),
        "node_index": _sql("node", """
SELECT row_number() OVER (ORDER BY node) - 1 AS node_id, node FROM node WHERE node_type = 'user'"""),
        "edge_index": _sql("edge node", """
SELECT u.node_id AS user_id, h.node_id AS host_id, e.auth_count, e.failed_count,
  CASE WHEN e.first_day < 7 THEN 'train' ELSE 'test' END AS split
FROM edge e
JOIN (SELECT node, row_number() OVER (ORDER BY node) - 1 AS node_id FROM node WHERE node_type = 'user') u
  ON u.node = e.src_user
JOIN (SELECT node, row_number() OVER (ORDER BY node) - 1 AS node_id FROM node WHERE node_type = 'host') h
  ON h.node = e.dst_computer"""),
        "node_features": _sql("edge", """
SELECT src_user, count(*) AS hosts, CAST(sum(auth_count) AS BIGINT) AS auth_count,
  round(CAST(sum(failed_count) AS DOUBLE) / sum(auth_count), 6) AS failed_share,
  round(CAST(sum(cross_host_count) AS DOUBLE) / sum(auth_count), 6) AS cross_host_share,
  max(active_days) AS most_active_days FROM edge GROUP BY 1"""),
        "ranked_anomalies": _sql("score", """
SELECT * FROM score ORDER BY score DESC, src_user, dst_computer LIMIT 20"""),
        "score_distribution": _sql("score", """
SELECT score, count(*) AS rows, any_value(position) AS rank, any_value(share) AS percent_rank,
  any_value(position) + count(*) - 1 AS rows_so_far
FROM (SELECT score, rank() OVER (ORDER BY score) AS position,
        round(percent_rank() OVER (ORDER BY score), 6) AS share FROM score) r
GROUP BY score"""),
        "score_threshold": _all("threshold"),
        "evaluation": _sql("flagged red_norm", """
SELECT tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
  round(coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0), 6) AS precision,
  round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 6) AS recall,
  round(coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0), 6) AS f1_score,
  round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 6) AS detection_rate,
  round(coalesce(fp / CAST(nullif(fp + tn, 0) AS DOUBLE), 0), 6) AS false_positive_rate
FROM (SELECT count(*) FILTER (WHERE hit AND attack) AS tp, count(*) FILTER (WHERE hit AND NOT attack) AS fp,
        count(*) FILTER (WHERE NOT hit AND attack) AS fn, count(*) FILTER (WHERE NOT hit AND NOT attack) AS tn
      FROM (SELECT coalesce(f.flagged = 1, false) AS hit, a.user IS NOT NULL AS attack
            FROM (SELECT DISTINCT user, dst_computer FROM red_norm) a
            FULL JOIN flagged f ON f.src_user = a.user AND f.dst_computer = a.dst_computer) j) c"""),
        "process_evidence": _all("evidence"),
        "user_incidents": _sql("alert", INCIDENTS),
        "host_features": _all("host_feature"),
        "adjacency_blocks": _sql("weighted", "SELECT user_id, host_id, round(weight, 6) AS weight FROM weighted"),
        "spread_features": _sql("weighted host_feature", """
SELECT user_id, round(sum(weight * f.users), 4) AS users, round(sum(weight * f.failed_share), 4) AS failed_share,
  round(sum(weight * f.cross_host_share), 4) AS cross_host_share
FROM weighted JOIN host_feature f USING (dst_computer) GROUP BY 1"""),
        "node_structure": _sql("arc node", CORES.strip()).replace("WITH ", "WITH RECURSIVE ", 1),
        "triage": _all("triaged"),
        "alert_documents": _sql("triaged", f"""
SELECT priority, CAST(to_json({{{', '.join(f"'{n}': {n}" for n in TRIAGE_COLUMNS)}}}) AS VARCHAR) AS alert
FROM triaged"""),
    }
