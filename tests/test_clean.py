from pyspark.sql import functions as F

from authweave.functions import clock, flags, text
from authweave.operators import clean
from authweave.schemas import AUTH_SCHEMA, CLEAN_COLUMNS, CLEAN_SCHEMA


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, expression, kind="string"):
    rows = column(spark, values, kind).select("i", expression(F.col("v")).alias("r")).collect()
    return [row.r for row in sorted(rows)]


def test_required_and_optional_text(spark):
    values = [" u1@dom ", "", "   ", None, "\tx", "unknown"]
    assert apply(spark, values, text.required_text) == ["U1@DOM", None, None, None, "\tX", "UNKNOWN"]
    assert apply(spark, values, text.optional_text) == [
        "U1@DOM", "UNKNOWN", "UNKNOWN", "UNKNOWN", "\tX", "UNKNOWN"]


def test_user_parts(spark):
    values = ["U1@DOM1", "U1", "@DOM", "A@", "A@B@C", "@", "", "C5$@D"]
    assert apply(spark, values, text.account_of) == [
        "U1", "U1", "UNKNOWN", "A", "A", "UNKNOWN", "UNKNOWN", "C5$"]
    assert apply(spark, values, text.domain_of) == [
        "DOM1", "UNKNOWN", "DOM", "UNKNOWN", "B@C", "UNKNOWN", "UNKNOWN", "D"]


def test_time_parts(spark):
    times = [0, 1, 86_399, 86_400, -5, 604_799, None, 2**62, -(2**63)]
    assert apply(spark, times, clock.day_index, "bigint") == [0, 0, 0, 1, -1, 6, None, None, None]
    seconds = apply(spark, times[:6], clock.second_of_day, "bigint")
    assert seconds == [0, 1, 86_399, 0, 86_395, 86_399]
    assert apply(spark, [0, 3_599, 3_600, 86_399], clock.hour_of, "int") == [0, 0, 1, 23]


def test_flags_are_never_null(spark):
    assert apply(spark, ["SUCCESS", "FAIL", "FAILURE", "PENDING", None], flags.success_flag) == [1, 0, 0, -1, -1]
    assert apply(spark, ["LOGON", "LOGOFF", "TGS", None], flags.is_logon) == [1, 0, 0, 0]
    assert apply(spark, ["LOGON", "LOGOFF", "TGS", None], flags.is_logoff) == [0, 1, 0, 0]
    assert apply(spark, ["C1$", "C$1", None], flags.is_machine_account) == [1, 0, 0]
    assert apply(spark, ["A", None], lambda c: flags.same(c, F.lit("A"))) == [1, 0]
    assert apply(spark, ["A", None, "B"], lambda c: flags.differs(c, F.lit("A"))) == [0, 0, 1]


def auth(spark, *rows):
    return spark.createDataFrame(list(rows), AUTH_SCHEMA)


ROW = (90_000, " u1@dom1", "U1@DOM1 ", "c1", "C1 ", "ntlm", None, "LogOn", "Success")


def test_clean_row(spark):
    cleaned = clean.clean_auth(auth(spark, ROW))
    assert cleaned.columns == CLEAN_COLUMNS
    assert [f.dataType for f in cleaned.schema] == [f.dataType for f in CLEAN_SCHEMA]
    row = cleaned.first().asDict()
    assert row == {
        "time": 90_000, "day_index": 1, "second_of_day": 3_600, "hour": 1,
        "src_user": "U1@DOM1", "src_user_account": "U1", "src_user_domain": "DOM1",
        "dst_user": "U1@DOM1", "dst_user_account": "U1", "dst_user_domain": "DOM1",
        "src_computer": "C1", "dst_computer": "C1", "auth_type": "NTLM", "logon_type": "UNKNOWN",
        "auth_orientation": "LOGON", "success": "SUCCESS", "success_flag": 1, "is_failure": 0,
        "is_logon": 1, "is_logoff": 0, "src_is_machine_account": 0, "dst_is_machine_account": 0,
        "same_user": 1, "same_computer": 1, "cross_host": 0,
    }


def test_rows_without_required_names_are_dropped(spark):
    def with_value(position, value):
        return tuple(value if i == position else v for i, v in enumerate(ROW))
    rows = [with_value(p, v) for p in (1, 3, 4) for v in (None, "", "  ")] + [with_value(0, None)]
    assert clean.clean_auth(auth(spark, *rows)).count() == 0
    assert clean.clean_auth(auth(spark, with_value(2, None))).first().dst_user == "UNKNOWN"


def test_keys_equal_those_of_the_clean_table(spark):
    rows = [ROW, (1, "", "x", "c1", "c2", None, None, None, None), (None, *ROW[1:]),
            (2, "a\t ", None, " c9", "c 2", None, None, None, None)]
    table = auth(spark, *rows)
    keys = clean.clean_keys(table)
    assert sorted(map(tuple, keys.collect())) == sorted(
        map(tuple, clean.clean_auth(table).select(*keys.columns).collect()))


def test_window_edge(spark):
    times = column(spark, [604_799, 604_800, None, -1], "bigint").withColumnRenamed("v", "time")
    assert sorted(row.time for row in clean.before_day(times, 7).collect()) == [-1, 604_799]
