"""Headerless comma CSV logs with `?` for missing values.

Every reader keeps malformed rows and marks them; `well_formed` drops them. Column
pruning is off in the CSV parser, because a pruned parse no longer sees the number
of fields and would let short and long rows pass.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from authweave.schemas import AUTH_SCHEMA, MISSING_MARK, PROCESS_SCHEMA, REDTEAM_SCHEMA

CORRUPT = "_corrupt"
CSV_DIALECT = {"header": "false", "sep": ",", "nullValue": MISSING_MARK, "quote": '"', "escape": '"'}


def _marked(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def read_log(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    return (
        spark.read.options(**CSV_DIALECT)
        .option("mode", "PERMISSIVE")
        .option("columnPruning", "false")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(_marked(schema))
        .csv(paths)
    )


def read_auth_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return read_log(spark, paths, AUTH_SCHEMA)


def read_process_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return read_log(spark, paths, PROCESS_SCHEMA)


def read_redteam_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return read_log(spark, paths, REDTEAM_SCHEMA)


def is_malformed(log: DataFrame):
    """Wrong number of fields, or a time that is missing or not an integer."""
    broken = F.col("time").isNull()
    return broken | F.col(CORRUPT).isNotNull() if CORRUPT in log.columns else broken


def well_formed(log: DataFrame) -> DataFrame:
    return log.filter(~is_malformed(log)).drop(CORRUPT)
