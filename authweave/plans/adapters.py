"""The three logs derived from the `events` test table.

The text is plain SQL that Spark and DuckDB read alike; only the seconds counter differs.
Its noise (nulls, blanks, mixed case, padding, odd user names, offsets around the context
window) is fixed, so both engines start from the same rows.
"""

from pyspark.sql import DataFrame, SparkSession

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
SPARK_SECONDS = "timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)"
DUCKDB_SECONDS = "date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts)"

AUTH_LOG = """
SELECT event_id,
  CASE WHEN event_id % 211 = 5 THEN NULL ELSE <SEC> END AS time,
  CASE WHEN event_id % 97 = 1 THEN NULL
       WHEN event_id % 83 = 5 THEN 'unknown'
       WHEN event_id % 89 = 2 THEN '   '
       WHEN event_id % 13 = 0 THEN concat('c', CAST(user_id % 20 AS STRING), '$@dom1')
       WHEN event_id % 17 = 0 THEN '@dom2'
       ELSE concat(CASE WHEN event_id % 3 = 0 THEN ' u' ELSE 'u' END, CAST(user_id AS STRING), '@dom',
                   CAST(user_id % 3 AS STRING), CASE WHEN event_id % 3 = 0 THEN ' ' ELSE '' END) END AS src_user,
  CASE WHEN event_id % 11 = 4 THEN NULL
       WHEN event_id % 19 = 0 THEN 'u1@dom1@x'
       WHEN event_id % 23 = 0 THEN 'anonymous logon'
       WHEN event_id % 31 = 0 THEN concat('C', CAST(user_id % 20 AS STRING), '$@DOM1')
       ELSE concat('U', CAST(user_id + event_id % 2 AS STRING), '@DOM',
                   CASE WHEN event_id % 2 = 0 THEN CAST(user_id % 3 AS STRING) ELSE '1' END) END AS dst_user,
  CASE WHEN event_id % 101 = 3 THEN '' ELSE concat('c', CAST(user_id % 20 AS STRING)) END AS src_computer,
  CASE WHEN event_id % 103 = 3 THEN NULL WHEN event_id % 107 = 9 THEN 'Unknown' ELSE concat('C', CAST((event_id * 7) % 20 AS STRING), ' ') END AS dst_computer,
  CASE event_type WHEN 'click' THEN 'NTLM' WHEN 'view' THEN 'Kerberos' WHEN 'error' THEN 'Negotiate'
       WHEN 'signup' THEN '' ELSE NULL END AS auth_type,
  CASE user_id % 4 WHEN 0 THEN 'Network' WHEN 1 THEN 'Interactive' WHEN 2 THEN 'Batch' ELSE NULL END AS logon_type,
  CASE event_id % 5 WHEN 0 THEN 'LogOn' WHEN 1 THEN 'LogOff' WHEN 2 THEN ' logon ' WHEN 3 THEN 'TGS' ELSE NULL END AS auth_orientation,
  CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'Fail'
       WHEN event_type = 'error' THEN 'Failure'
       WHEN event_id % 29 = 0 THEN 'Pending'
       WHEN event_id % 37 = 0 THEN NULL
       ELSE 'Success' END AS success
FROM <EVENTS>
"""

_ATTACKS = """
SELECT time, trim(src_user) AS user, src_computer,
  CASE WHEN event_id % 140 = 77 THEN 'C999' ELSE dst_computer END AS dst_computer
FROM <AUTH>
WHERE event_id % <N> = 7 AND time IS NOT NULL AND src_user IS NOT NULL AND dst_computer IS NOT NULL
"""
# Some attacks are logged twice or three times.
REDTEAM_LOG = "UNION ALL".join(_ATTACKS.replace("<N>", n) for n in ("35", "105", "245"))

PROCESS_LOG = """
SELECT <SEC> + CASE event_id % 6 WHEN 0 THEN -301 WHEN 1 THEN -300 WHEN 2 THEN 0
                                 WHEN 3 THEN 299 WHEN 4 THEN 300 ELSE 301 END AS time,
  concat('u', CAST(user_id AS STRING), '@dom', CAST((user_id + event_id % 2 * 3) % 3 AS STRING)) AS user,
  CASE WHEN event_id % 4 < 2 THEN concat('C', CAST((event_id * 7) % 20 AS STRING), ' ')
       ELSE concat('c', CAST(user_id % 20 AS STRING)) END AS computer,
  concat('P', CAST(event_id % 40 AS STRING)) AS process,
  CASE WHEN event_id % 2 = 0 THEN 'Start' ELSE 'End' END AS event_type
FROM <EVENTS>
"""

# The authentication log as CSV lines, some with a field too few or too many, some with
# a time that is no number.
AUTH_LINES = """
SELECT CASE WHEN event_id % 50 = 9 THEN concat(front, ',LogOn')
            WHEN event_id % 50 = 19 THEN concat(front, ',LogOn,Success,extra')
            WHEN event_id % 50 = 29 THEN concat('x', front, ',LogOn,Success')
            ELSE concat(front, ',LogOn,Success') END AS value
FROM (SELECT event_id,
        concat_ws(',', coalesce(CAST(time AS STRING), '?'), coalesce(src_user, '?'), coalesce(dst_user, '?'),
          src_computer, coalesce(dst_computer, '?'), coalesce(auth_type, '?'), coalesce(logon_type, '?')) AS front
      FROM <AUTH>) AS fronts
"""

# The red-team log as CSV lines with the same kinds of fault.
REDTEAM_LINES = """
SELECT CASE WHEN time % 50 < 5 THEN concat_ws(',', CAST(time AS STRING), user, src_computer)
            WHEN time % 50 < 9 THEN concat_ws(',', CAST(time AS STRING), user, src_computer, dst_computer, 'extra')
            WHEN time % 50 < 12 THEN concat_ws(',', 'x', user, src_computer, dst_computer)
            ELSE concat_ws(',', CAST(time AS STRING), user, src_computer, dst_computer) END AS value
FROM <REDTEAM>
"""


# The process log as CSV lines with the same kinds of fault.
PROCESS_LINES = """
SELECT CASE WHEN time % 50 = 9 THEN front
            WHEN time % 50 = 19 THEN concat(front, ',End,extra')
            WHEN time % 50 = 29 THEN concat('x', front, ',End')
            ELSE concat(front, ',', event_type) END AS value
FROM (SELECT time, event_type,
        concat_ws(',', coalesce(CAST(time AS STRING), '?'), coalesce(user, '?'), coalesce(computer, '?'), process) AS front
      FROM <PROCESS>) AS fronts
"""

# A clean table with rows in wrong days: a negative one, none, one too late, the next one.
WRONG_DAY = """
CASE WHEN time % 997 = 0 THEN -1 WHEN time % 997 = 1 THEN NULL WHEN time % 997 = 2 THEN 31
     WHEN time % 997 = 3 THEN (day_index + 1) % 30 ELSE day_index END
"""


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def _derived(spark: SparkSession, folder: str, text: str) -> DataFrame:
    return spark.sql(text.replace("<SEC>", SPARK_SECONDS).replace("<EVENTS>", "{events}"), events=events(spark, folder))


def _over(text: str, slot: str, table: DataFrame) -> DataFrame:
    return table.sparkSession.sql(text.replace(slot, "{table}"), table=table)


def auth_log(spark: SparkSession, folder: str) -> DataFrame:
    return _derived(spark, folder, AUTH_LOG)


def process_log(spark: SparkSession, folder: str) -> DataFrame:
    return _derived(spark, folder, PROCESS_LOG)


def redteam_log(spark: SparkSession, folder: str) -> DataFrame:
    return _over(REDTEAM_LOG, "<AUTH>", auth_log(spark, folder))


def auth_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _over(AUTH_LINES, "<AUTH>", auth_log(spark, folder))


def process_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _over(PROCESS_LINES, "<PROCESS>", process_log(spark, folder))


def redteam_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _over(REDTEAM_LINES, "<REDTEAM>", redteam_log(spark, folder))
