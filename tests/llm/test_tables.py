"""Memory of Python workers, settings and shuffle files."""

import os
import time

import numpy as np

from authweave.llm.tables import brief_shuffles, lean, small_reads, worker_cache

MB = 1 << 20


def resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


def test_a_task_empties_the_caches_of_other_operators():
    cache = worker_cache()
    cache["words"] = [0] * 1000
    kept = list(lean(lambda batches: iter([len(cache)]), lambda: cache)(iter([])))
    assert kept == [1] and list(lean(lambda batches: iter([len(cache)]))(iter([]))) == [0]


def test_a_task_leaves_its_worker_without_freed_memory():
    left = []

    def run(batches):
        for number in batches:
            held = [np.ones(256) for _ in range(number)]
            left.append(np.ones(256))  # stands behind the others, so that the heap's end is in use
            yield len(held)

    assert list(lean(run)(iter([1]))) == [1]
    before = resident()
    assert list(lean(run)(iter([100_000, 100_000]))) == [100_000, 100_000]
    assert resident() - before < 60 * MB


def test_settings_hold_for_a_while(spark):
    scan, batch = "spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxBytesPerBatch"
    before, own = (spark.conf.get(scan), spark.conf.get(batch)), spark.conf.get(batch, None)
    spark.conf.set(batch, "1000")
    try:
        with small_reads(spark, 5000, 2000):
            assert (spark.conf.get(scan), spark.conf.get(batch)) == ("5000", "1000")
        assert (spark.conf.get(scan), spark.conf.get(batch)) == (before[0], "1000")
    finally:
        if own is None:
            spark.conf.unset(batch)
        else:
            spark.conf.set(batch, own)
    assert (spark.conf.get(scan), spark.conf.get(batch)) == before


def test_shuffle_files_go_with_their_action(spark, tmp_path):
    def files():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        found = disk.getAllFiles()
        return {found.apply(k).getName() for k in range(found.size()) if found.apply(k).getName().endswith(".data")}

    before = files()
    with brief_shuffles(spark):
        spark.range(1000).repartition(3).write.parquet(str(tmp_path / "rows"))
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert left == set() and spark.read.parquet(str(tmp_path / "rows")).count() == 1000
