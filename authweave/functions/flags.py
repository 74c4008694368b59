"""0/1 flags of the clean table; success_flag is 1, 0 or -1 for an unknown outcome."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the normalized log.
SUCCESS = "SUCCESS"
FAILURES = ["FAIL", "FAILURE"]
LOGON = "LOGON"
LOGOFF = "LOGOFF"
MACHINE_SUFFIX = "$"


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def success_flag(success: Column) -> Column:
    return F.when(success == SUCCESS, 1).when(success.isin(FAILURES), 0).otherwise(-1)


def is_failure(outcome: Column) -> Column:
    return flag(outcome == 0)


def is_logon(orientation: Column) -> Column:
    return flag(orientation == LOGON)


def is_logoff(orientation: Column) -> Column:
    return flag(orientation == LOGOFF)


def is_machine_account(account: Column) -> Column:
    return flag(account.endswith(MACHINE_SUFFIX))


def same(left: Column, right: Column) -> Column:
    return flag(left == right)


def differs(left: Column, right: Column) -> Column:
    return flag(left != right)
