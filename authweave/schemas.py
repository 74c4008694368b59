"""Column names, types and fixed values shared by the whole package."""

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

SECONDS_PER_DAY = 86_400
SECONDS_PER_HOUR = 3_600
CONTEXT_WINDOW_SECONDS = 300
MISSING_MARK = "?"
UNKNOWN = "UNKNOWN"

# Column names and order of the three logs and of the clean table.
AUTH_TEXT_COLUMNS = [
    "src_user", "dst_user", "src_computer", "dst_computer",
    "auth_type", "logon_type", "auth_orientation", "success",
]
PROCESS_TEXT_COLUMNS = ["user", "computer", "process", "event_type"]
REDTEAM_TEXT_COLUMNS = ["user", "src_computer", "dst_computer"]


def _log_schema(text_columns):
    return StructType(
        [StructField("time", LongType())]
        + [StructField(name, StringType()) for name in text_columns]
    )


AUTH_SCHEMA = _log_schema(AUTH_TEXT_COLUMNS)
PROCESS_SCHEMA = _log_schema(PROCESS_TEXT_COLUMNS)
REDTEAM_SCHEMA = _log_schema(REDTEAM_TEXT_COLUMNS)

_CLEAN_TEXT = [
    "src_user", "src_user_account", "src_user_domain",
    "dst_user", "dst_user_account", "dst_user_domain",
    "src_computer", "dst_computer",
    "auth_type", "logon_type", "auth_orientation", "success",
]
# The yes-or-no columns.
FLAG_COLUMNS = [
    "is_failure", "is_logon", "is_logoff",
    "src_is_machine_account", "dst_is_machine_account",
    "same_user", "same_computer", "cross_host",
]
CLEAN_SCHEMA = StructType(
    [StructField("time", LongType())]
    + [StructField(name, IntegerType()) for name in ("day_index", "second_of_day", "hour")]
    + [StructField(name, StringType()) for name in _CLEAN_TEXT]
    + [StructField(name, IntegerType()) for name in ["success_flag", *FLAG_COLUMNS]]
)
CLEAN_COLUMNS = CLEAN_SCHEMA.fieldNames()

# Columns that must not be null.
CRITICAL_COLUMNS = [
    "time", "day_index", "second_of_day", "hour",
    "src_user", "src_computer", "dst_computer",
]

# The four columns that identify an attack in the authentication log.
AUTH_KEY = ["time", "src_user", "src_computer", "dst_computer"]
REDTEAM_KEY = ["time", "user", "src_computer", "dst_computer"]
