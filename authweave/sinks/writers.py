"""Writers. Existing output is kept unless `overwrite` is asked for."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from authweave.functions.clock import day_index, floor_div
from authweave.schemas import MISSING_MARK, SECONDS_PER_HOUR
from authweave.sources.tables import BATCH, list_day_files

REPLACED = "replaced"
STAGED_PART = 6 * SECONDS_PER_HOUR  # of a staged day, kept together up to the advisory size


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def _per_day(frame: DataFrame, part_seconds: int = SECONDS_PER_HOUR) -> DataFrame:
    """Days side by side, a large day split over several tasks; rows in time order.

    The part of the day as second key spreads a day even when a single task read it (a gzip file);
    REBALANCE lets adaptive execution join small pieces and cut large ones to the
    advisory size. A plain repartition on the day would hand a whole day to one task.
    """
    part = floor_div(F.col("time"), part_seconds)
    spread = frame.withColumn("_part", part).hint("rebalance", "day_index", "_part")
    return spread.drop("_part").sortWithinPartitions("day_index", "time")


def _csv(writer, path: str, header: bool) -> None:
    (
        writer.option("header", header)
        .option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_staged_days(auth: DataFrame, path: str, overwrite: bool = False) -> None:
    """Raw rows unchanged, one gzip CSV folder per day.

    A day has a file per part at most, unless a part passes the advisory size: hours, dealt
    to tasks one by one, were 24 small files a day, and a stream pays a batch for every few files.
    """
    staged = _per_day(auth.withColumn("day_index", day_index(F.col("time"))), STAGED_PART)
    writer = (
        staged.write.mode(_mode(overwrite)).partitionBy("day_index")
        .option("compression", "gzip").option("nullValue", MISSING_MARK)
    )
    _csv(writer, path, header=False)


def write_clean_table(
    clean: DataFrame, path: str, overwrite: bool = False, rows_per_file: int = 20_000_000
) -> None:
    """Snappy Parquet, one folder per day."""
    (
        _per_day(clean).write.mode(_mode(overwrite)).partitionBy("day_index")
        .option("compression", "snappy").option("maxRecordsPerFile", rows_per_file)
        .option("partitionOverwriteMode", "static")
        .parquet(path)
    )


def replace_days(
    clean: DataFrame, path: str, days: list[int], rows_per_file: int = 20_000_000
) -> None:
    """Rewrite the listed days with their rows in `clean`; other days stay.

    Rows of other days are left out; a listed day without rows loses its folder. In a table
    that a stream writes, the new rows are one more batch of their days, and the batches before
    go; a call that fails between the two is put right by calling it again.
    """
    old = _paths_by_day(clean.sparkSession, path, days)
    chosen = clean.filter(F.col("day_index").isin(days))
    streamed = BATCH in clean.sparkSession.read.parquet(path).columns
    if streamed:
        commit_batch(chosen, path, f"{REPLACED}-{uuid.uuid4().hex}", rows_per_file)
    else:
        (
            _per_day(chosen).write.mode("overwrite").partitionBy("day_index")
            .option("compression", "snappy").option("maxRecordsPerFile", rows_per_file)
            .option("partitionOverwriteMode", "dynamic")
            .parquet(path)
        )
    new = _paths_by_day(clean.sparkSession, path, days)
    for day, before in old.items():
        if new[day] == before:  # nothing was written there
            remove(clean.sparkSession, f"{path}/day_index={day}")
        elif streamed:
            for folder in {file.rsplit("/", 1)[0] for file in before}:
                remove(clean.sparkSession, folder)


def _paths_by_day(spark: SparkSession, path: str, days: list[int]) -> dict[int, set[str]]:
    files = list_day_files(spark, path).filter(F.col("day_index").isin(days))
    found = files.groupBy("day_index").agg(F.collect_set("path").alias("paths")).collect()
    return {row.day_index: set(row.paths) for row in found}


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of files that nobody reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def commit_batch(
    clean: DataFrame, path: str, batch: str, rows_per_file: int = 20_000_000
) -> None:
    """Adds the rows of one batch to their days, in a folder that bears the batch's name.

    Only the folders of this batch are overwritten, so writing a batch twice leaves it there
    once. It must hold the same rows each time, as a batch of a stream does: its input is fixed in
    the checkpoint before it runs.
    """
    (
        _per_day(clean).withColumn(BATCH, F.lit(batch))
        .write.mode("overwrite").partitionBy("day_index", BATCH)
        .option("compression", "snappy").option("maxRecordsPerFile", rows_per_file)
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def write_table_csv(frame: DataFrame, path: str, overwrite: bool = False) -> None:
    """Result table with a header line."""
    _csv(frame.write.mode(_mode(overwrite)), path, header=True)


def write_sample_csv(
    frame: DataFrame, path: str, rows: int, order: list[str | Column], overwrite: bool = False
) -> None:
    """First rows in the given order, as one CSV file with a header line."""
    write_table_csv(frame.orderBy(*order).limit(rows).coalesce(1), path, overwrite)


def write_report(report: DataFrame, path: str, overwrite: bool = False) -> None:
    """A report of few rows as one JSON file; null fields are written out."""
    report.coalesce(1).write.mode(_mode(overwrite)).option("ignoreNullFields", False).json(path)
