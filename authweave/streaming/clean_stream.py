"""Continuous cleaning and first contacts: new staged CSV files in, tables out.

The cleaning transform keeps no state, so the batch function is used unchanged. First contacts
keep one row per user and host in the state store.

Every micro-batch is written to folders that bear the name of the stream and the number of the
batch, and only those are overwritten. What a batch reads is fixed in the checkpoint before it
runs, so a batch that fails after its write, and is run again, leaves its rows there once.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from authweave.operators.clean import clean_auth
from authweave.schemas import AUTH_SCHEMA
from authweave.sinks.writers import commit_batch
from authweave.sources.raw_logs import CORRUPT, CSV_DIALECT, well_formed
from authweave.sources.tables import BATCH

EARLIEST, FOUND = "earliest", "found"


def stream_auth_log(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    """Rows of the CSV files in a folder; with `files_per_batch` no more files go together."""
    marked = StructType([*AUTH_SCHEMA.fields, StructField(CORRUPT, StringType())])
    reader = (
        spark.readStream.options(**CSV_DIALECT)
        .option("columnPruning", "false")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return well_formed(reader.schema(marked).csv(folder))


def _batch_name(checkpoint: str, number: int) -> str:
    """Differs between streams, that is checkpoints, which may write to one table."""
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    return f"s{stream}-{number:09d}"


def clean_new_files(
    spark: SparkSession, folder: str, table: str, checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Clean every file not seen before and add it to the table once, then stop.

    The table is read with `tables.read_clean_table`, and its days can be replaced.
    """
    return (
        clean_auth(stream_auth_log(spark, folder, files_per_batch))
        .writeStream
        .foreachBatch(lambda batch, number: commit_batch(batch, table, _batch_name(checkpoint, number)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def contact_changes(clean: DataFrame) -> DataFrame:
    """Contacts that a micro-batch shows for the first time, or at an earlier time than known.

    Written in update mode. The state holds per user and host the earliest time and when it
    was found: rows at that time seen again later change nothing, and a late row with an
    earlier time corrects the contact. No state is ever dropped, because a host is new only
    to a user who has never been there. Rows are reduced to pairs per task before the shuffle,
    so a user or pair with a large share of all rows is a few rows there.
    """
    now = F.current_timestamp()  # one value per micro-batch, the same when it runs again
    earliest = F.min(F.struct("time", "day_index", FOUND))
    return (
        clean.withColumn(FOUND, now).groupBy("src_user", "dst_computer").agg(earliest.alias(EARLIEST))
        .where(F.col(f"{EARLIEST}.{FOUND}") == now)
        .select(
            "src_user", "dst_computer", F.col(f"{EARLIEST}.time").alias("first_time"),
            F.col(f"{EARLIEST}.day_index").alias("first_day"),
        )
    )


def watch_contacts(
    spark: SparkSession, folder: str, table: str, checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Adds the contact changes of every file not seen before to a table, then stops."""

    def commit(batch: DataFrame, number: int) -> None:
        (
            batch.withColumn(BATCH, F.lit(_batch_name(checkpoint, number)))
            .write.mode("overwrite").partitionBy(BATCH)
            .option("partitionOverwriteMode", "dynamic").parquet(table)
        )

    return (
        contact_changes(clean_auth(stream_auth_log(spark, folder, files_per_batch)))
        .writeStream.outputMode("update").foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_contacts(spark: SparkSession, table: str) -> DataFrame:
    """(src_user, dst_computer, first_time, first_day): the contacts after all corrections."""
    best = F.min(F.struct("first_time", "first_day"))
    changes = spark.read.parquet(table)
    return changes.groupBy("src_user", "dst_computer").agg(best.alias(EARLIEST)).select(
        "src_user", "dst_computer", f"{EARLIEST}.first_time", f"{EARLIEST}.first_day"
    )
