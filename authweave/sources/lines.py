"""Logs whose line numbers matter (red-team log, reports of malformed lines)."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from authweave.schemas import REDTEAM_TEXT_COLUMNS
from authweave.sources.raw_logs import CORRUPT, CSV_DIALECT
from authweave.workspace import pinned


def read_numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_number from 1, value), blank lines included.

    A line's place inside its block comes from the reader; the number of lines in
    the blocks before it (few per file) is added. The lines are pinned first, so both
    passes see the same blocks.
    """
    lines = pinned(
        spark.read.text(path).select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
        )
    )
    blocks = lines.groupBy("file", "block").agg(
        F.min("place").alias("first_place"), F.count("*").alias("lines")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = blocks.withColumn("skipped", F.coalesce(F.sum("lines").over(earlier), F.lit(0)))
    return lines.join(starts, ["file", "block"]).select(
        "file",
        (F.col("skipped") + F.col("place") - F.col("first_place") + 1).alias("line_number"),
        "value",
    )


def split_fields(lines: DataFrame, names: list[str]) -> DataFrame:
    """Adds the text fields of each line and `wrong_fields`, true on a wrong field count."""
    ddl = ", ".join(f"`{name}` string" for name in [*names, CORRUPT])
    options = {**CSV_DIALECT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    fields = F.from_csv("value", ddl, options)
    blank = F.length(F.trim("value")) == 0
    return (
        lines.withColumn("fields", fields)
        .withColumn("wrong_fields", blank | F.col(f"fields.{CORRUPT}").isNotNull())
        .select(*lines.columns, "wrong_fields", *[F.col(f"fields.{name}") for name in names])
    )


def read_redteam_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Red-team log with `source_row` (line in its file) and a time that may be null."""
    numbered = read_numbered_lines(spark, path).withColumnRenamed("line_number", "source_row")
    return split_fields(numbered, ["time", *REDTEAM_TEXT_COLUMNS]).withColumn(
        "time", F.col("time").try_cast("bigint")
    )


def malformed_lines(lines: DataFrame) -> DataFrame:
    """Line number and content of every line with a wrong number of fields."""
    return lines.filter("wrong_fields").select(
        "file", F.col("source_row").alias("line_number"), F.col("value").alias("content")
    )


def valid_lines(lines: DataFrame) -> DataFrame:
    """Events in the log: right field count; the time may still be null."""
    return lines.filter(~F.col("wrong_fields")).select(
        "file", "source_row", "time", *REDTEAM_TEXT_COLUMNS
    )
