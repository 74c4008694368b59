"""Clean table, its files, and earlier reports."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authweave.schemas import CLEAN_COLUMNS

BATCH = "batch"  # second partition column of tables that a stream writes


def read_clean_table(spark: SparkSession, root: str, days: int | None = None) -> DataFrame:
    """All days as one table, columns in their fixed order; `days` prunes partitions.

    The batches of a table that a stream writes are not told apart.
    """
    table = spark.read.parquet(root).drop(BATCH)
    if days is not None:
        table = table.filter(F.col("day_index").between(0, days - 1))
    known = [name for name in CLEAN_COLUMNS if name in table.columns]
    return table.select(*known, *[name for name in table.columns if name not in known])


def list_day_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(day_index, path, length) of each data file; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return files.select(F.col("day_index").cast("int").alias("day_index"), "path", "length")


def expected_days(spark: SparkSession, days: int) -> DataFrame:
    return spark.range(days).select(F.col("id").cast("int").alias("day_index"))


def missing_days(files: DataFrame, days: int) -> DataFrame:
    """Expected days that have no file."""
    spine = expected_days(files.sparkSession, days)
    return spine.join(files.select("day_index").distinct(), "day_index", "left_anti")


def require_days(files: DataFrame, days: int) -> None:
    """Fail before a long job when a day's input is absent."""
    absent = [row.day_index for row in missing_days(files, days).orderBy("day_index").collect()]
    if absent:
        raise FileNotFoundError(f"no input files for day(s): {absent}")


def read_report(spark: SparkSession, path: str) -> DataFrame | None:
    """An earlier JSON report, or None when there is none."""
    try:
        return spark.read.json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def size_per_day(files: DataFrame) -> DataFrame:
    """Data files and megabytes of each day."""
    return files.groupBy("day_index").agg(
        F.count("*").alias("files"),
        F.round(F.sum("length") / (1024 * 1024), 2).alias("size_mb"),
    )


def reported_days(report: DataFrame) -> DataFrame:
    """(day_index, rows) from the per-day object of a staging report."""
    per_day = F.from_json(F.to_json("rows_per_day"), "map<string, bigint>")
    return report.select(F.explode(per_day).alias("day", "rows")).select(
        F.col("day").cast("int").alias("day_index"), "rows"
    )
