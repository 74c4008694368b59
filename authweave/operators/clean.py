"""From the raw authentication log to the 25-column clean table. Map-only."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authweave.functions import clock, flags, text
from authweave.schemas import CLEAN_COLUMNS, SECONDS_PER_DAY

REQUIRED = ["src_user", "src_computer", "dst_computer"]
OPTIONAL = ["dst_user", "auth_type", "logon_type", "auth_orientation", "success"]


def keep_critical(auth: DataFrame) -> DataFrame:
    """Rows that can be placed in time and between two hosts; raw or normalized names.

    A null name fails the comparison too. The test is on the columns as they come, so
    names of dropped rows are never normalized.
    """
    named = [F.trim(F.col(name)) != "" for name in REQUIRED]
    return auth.filter(reduce(and_, [F.col("time").isNotNull(), *named]))


def normalized_fields() -> dict[str, Column]:
    """Required names become null when blank, optional ones UNKNOWN."""
    required = {name: text.required_text(F.col(name)) for name in REQUIRED}
    optional = {name: text.optional_text(F.col(name)) for name in OPTIONAL}
    return {**required, **optional}


def time_parts() -> dict[str, Column]:
    second = clock.second_of_day(F.col("time"))
    return {
        "day_index": clock.day_index(F.col("time")),
        "second_of_day": second,
        "hour": clock.hour_of(second),
    }


def user_parts() -> dict[str, Column]:
    return {
        f"{user}_{part}": take(F.col(user))
        for user in ("src_user", "dst_user")
        for part, take in (("account", text.account_of), ("domain", text.domain_of))
    }


def result_flags() -> dict[str, Column]:
    outcome = flags.success_flag(F.col("success"))
    return {
        "success_flag": outcome,
        "is_failure": flags.is_failure(outcome),
        "is_logon": flags.is_logon(F.col("auth_orientation")),
        "is_logoff": flags.is_logoff(F.col("auth_orientation")),
    }


def account_flags() -> dict[str, Column]:
    """Needs the user parts."""
    return {
        f"{side}_is_machine_account": flags.is_machine_account(F.col(f"{side}_user_account"))
        for side in ("src", "dst")
    }


def relation_flags() -> dict[str, Column]:
    hosts = F.col("src_computer"), F.col("dst_computer")
    return {
        "same_user": flags.same(F.col("src_user"), F.col("dst_user")),
        "same_computer": flags.same(*hosts),
        "cross_host": flags.differs(*hosts),
    }


def clean_auth(auth: DataFrame) -> DataFrame:
    """The whole transform; works on batch and streaming input alike.

    The steps are grouped so that Spark puts the later ones into a generated method of
    their own: in one method they pass the size up to which the JVM compiles it, and the
    stage runs several times slower.
    """
    return (
        auth.transform(keep_critical)
        .withColumns(normalized_fields())
        .withColumns(time_parts())
        .withColumns(user_parts())
        .withColumns({**result_flags(), **account_flags(), **relation_flags()})
        .select(*CLEAN_COLUMNS)
    )


def clean_keys(auth: DataFrame) -> DataFrame:
    """Only the key columns of the clean table, for joins that need no others.

    Blank names are gone after the first step, so no value turns null here.
    """
    names = [F.upper(F.trim(F.col(name))).alias(name) for name in REQUIRED]
    return auth.transform(keep_critical).select("time", *names)


def before_day(log: DataFrame, days: int) -> DataFrame:
    """Rows of the first `days` days; the cutoff itself is outside."""
    if days <= 0:
        raise ValueError("days must be greater than zero")
    return log.filter(F.col("time") < F.lit(days * SECONDS_PER_DAY))
