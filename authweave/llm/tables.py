"""Reading the input tables, keeping intermediate ones in the shared folder, memory of Python tasks."""

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from authweave.workspace import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bytes(spark: SparkSession, name: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))


def small_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Bounds the bytes of a batch that goes to Python, where the session has no lower bound."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = _bytes(spark, name)
    if now <= 0 or now > size:
        spark.conf.set(name, str(size))


@contextmanager
def _set(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The settings for a while; afterwards they are as before."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def brief_shuffles(spark: SparkSession):
    """While this holds, the shuffle files of an action are deleted as soon as it has ended.

    Else they stay until the driver collects its garbage. Frames should be run once only: a
    second action on the same one writes its shuffles again.
    """
    return _set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def small_reads(spark: SparkSession, scan: int, batch: int = 8 << 20):
    """While this holds, a scan's partitions and the batches that go to Python have so many bytes at most."""
    limits = {"spark.sql.files.maxPartitionBytes": scan, "spark.sql.execution.arrow.maxBytesPerBatch": batch}
    now = {name: _bytes(spark, name) for name in limits}
    return _set(spark, {name: str(most) for name, most in limits.items() if not 0 < now[name] <= most})


_CACHES: list[dict] = []


def worker_cache() -> dict:
    """A cache of this process, for the tasks of one operator; tasks of others may empty it."""
    _CACHES.append({})
    return _CACHES[-1]


def give_back(but: dict | None = None) -> None:
    """Empties the caches of this Python worker, but for one, and returns its freed memory to the system.

    Workers are reused, and more of them may wait than tasks run: what each keeps of its largest
    task adds up in the executor. Without glibc only Arrow's pool is released.
    """
    for cache in _CACHES:
        if cache is not but:
            cache.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator], own: Callable[[], dict] | None = None) -> Callable[[Iterator], Iterator]:
    """The function of a task's batches, which starts and leaves its worker without freed memory.

    `own` gives, in the worker, the cache that stays for the next task.
    """

    def task(batches: Iterator) -> Iterator:
        but = own() if own else None
        give_back(but)
        try:
            yield from run(batches)
        finally:
            give_back(but)

    return task


def stored(frame: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """The rows written once under the shared folder: they survive lost executors and are
    the same, in the same order, however often they are read. `file_rows` bounds the rows of a file."""
    path = new_path(frame.sparkSession, label)
    writer = frame.write.option("maxRecordsPerFile", file_rows) if file_rows else frame.write
    writer.parquet(path)
    kept = frame.sparkSession.read.schema(frame.schema).parquet(path)
    kept._stored_path = path
    return kept


def again(frame: DataFrame) -> DataFrame:
    """The same stored table under new column identities, for joins with itself."""
    session = frame.sparkSession
    kept = session.read.schema(frame.schema).parquet(frame._stored_path)
    kept._stored_path = frame._stored_path
    return kept


def forget(*frames: DataFrame) -> None:
    """Deletes the files behind tables made by `stored` that nobody reads any more."""
    for frame in frames:
        session = frame.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(frame._stored_path)
        path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)
