"""A clean table with its quality measures per day kept beside it.

The measures merge, so a replaced day costs a pass over that day only. They are written after the
rows; a call that fails between the two is put right by calling it again.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authweave.operators.quality import daily_measures
from authweave.sinks import writers
from authweave.sources import tables


def write_table(clean: DataFrame, path: str, measures: str, days: int, overwrite: bool = False) -> None:
    """Writes the table, and the measures of what is in its files."""
    writers.write_clean_table(clean, path, overwrite)
    written = tables.read_clean_table(clean.sparkSession, path)
    _write(daily_measures(written, days), measures, "static")


def replace_days(clean: DataFrame, path: str, measures: str, replaced: list[int], days: int) -> None:
    """Replaces days of the table and their measures; the files of other days are not read.

    The measures of a day that became empty go.
    """
    spark = clean.sparkSession
    writers.replace_days(clean, path, replaced)
    chosen = tables.read_clean_table(spark, path).filter(F.col("day_index").isin(replaced))
    fresh = daily_measures(chosen, days)
    _write(fresh, measures, "dynamic")
    left = {row.day_index for row in spark.read.parquet(measures).select("day_index").collect()}
    present = {row.day_index for row in chosen.select("day_index").distinct().collect()}
    for day in set(replaced) & left - present:
        writers.remove(spark, f"{measures}/day_index={day}")


def read_measures(spark: SparkSession, measures: str) -> DataFrame:
    """A row per day that has rows."""
    return spark.read.parquet(measures)


def _write(daily: DataFrame, path: str, overwrite: str) -> None:
    (
        daily.repartition("day_index").write.mode("overwrite").partitionBy("day_index")
        .option("partitionOverwriteMode", overwrite).parquet(path)
    )
