"""Where intermediate tables go: the shared folder the cluster names."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Checkpoint folder of the session; a temporary one only for a local master."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="authweave-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def pinned(frame: DataFrame) -> DataFrame:
    """Reliable checkpoint: rows and partitions stay the same however often they are read."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()
