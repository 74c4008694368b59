"""Normalization of identifiers and categories."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from authweave.schemas import UNKNOWN

AT = "@"
# Fixed value: the domain is what follows the first @, as long as it is on one line.
DOMAIN_PATTERN = r"@(.+)$"


def required_text(value: Column) -> Column:
    """Trimmed upper-case text; null when missing or blank."""
    return F.nullif(F.upper(F.trim(value)), F.lit(""))


def optional_text(value: Column) -> Column:
    """Trimmed upper-case text; UNKNOWN when missing or blank."""
    return F.coalesce(required_text(value), F.lit(UNKNOWN))


def _known(value: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(UNKNOWN))


def account_of(user: Column) -> Column:
    """Text before the first @, or all of it without one."""
    return _known(F.substring_index(user, AT, 1))


def domain_of(user: Column) -> Column:
    return _known(F.regexp_extract(user, DOMAIN_PATTERN, 1))
