import gzip

import pytest
from pyspark.sql import functions as F

from authweave.schemas import PROCESS_SCHEMA
from authweave.sources import lines, raw_logs, tables

LOG = "\n".join([
    "1,u1,c1,p1,Start",
    "2,u1,c1,p1",
    "3,u1,c1,p1,End,x",
    "x,u1,c1,p1,End",
    "?,u1,c1,p1,End",
    "",
    '5,?,"",?,"a ""b"",c"',
    "6, ?,,p2,End",
]) + "\n"


def written(path, content, zipped=True):
    opener = gzip.open if zipped else open
    with opener(path, "wt") as file:
        file.write(content)
    return str(path)


def test_malformed_rows(spark, tmp_path):
    log = raw_logs.read_process_log(spark, written(tmp_path / "proc.csv.gz", LOG))
    kept = raw_logs.well_formed(log)
    assert [tuple(row) for row in kept.orderBy("time").collect()] == [
        (1, "u1", "c1", "p1", "Start"),
        (5, None, "", None, 'a "b",c'),
        (6, " ?", None, "p2", "End"),
    ]
    assert kept.schema == PROCESS_SCHEMA


def test_counts_do_not_depend_on_the_columns_read(spark, tmp_path):
    log = raw_logs.read_process_log(spark, written(tmp_path / "proc.csv.gz", LOG))
    kept = raw_logs.well_formed(log)
    assert kept.count() == kept.select("user").count() == len(kept.collect()) == 3
    assert log.agg(F.count_if(raw_logs.is_malformed(log)).alias("n")).first().n == 4


def test_a_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        raw_logs.read_auth_log(spark, str(tmp_path / "absent.csv"))


REDTEAM = "10,u1,c1,c2\n20,u1,c1\n\nx,u2,c1,c3\n40,u3,c1,c2,y\n50,u4,c2,c2\n"


def test_redteam_lines(spark, tmp_path):
    read = lines.read_redteam_lines(spark, written(tmp_path / "red.csv.gz", REDTEAM))
    bad = {row.line_number: row.content for row in lines.malformed_lines(read).collect()}
    assert bad == {2: "20,u1,c1", 3: "", 5: "40,u3,c1,c2,y"}
    found = lines.valid_lines(read).orderBy("source_row").collect()
    assert {row.file.rsplit("/", 1)[1] for row in found} == {"red.csv.gz"}
    valid = [(row.source_row, row.time, row.user, row.src_computer, row.dst_computer) for row in found]
    assert valid == [(1, 10, "u1", "c1", "c2"), (4, None, "u2", "c1", "c3"), (6, 50, "u4", "c2", "c2")]


def test_line_numbers_across_blocks_and_files(spark, tmp_path):
    for name, count in (("a.txt", 5_000), ("b.txt", 3_000), ("c.txt", 1)):
        written(tmp_path / name, "".join(f"{name}-{i}\n" for i in range(1, count + 1)), zipped=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        read = lines.read_numbered_lines(spark, str(tmp_path))
        rows = read.select("value", "line_number").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == 8_001
    assert all(int(row.value.split("-")[1]) == row.line_number for row in rows)


def test_missing_days(spark):
    files = spark.createDataFrame([(0, "a", 1), (2, "b", 1), (2, "c", 1)], "day_index int, path string, length long")
    assert [row.day_index for row in tables.missing_days(files, 4).orderBy("day_index").collect()] == [1, 3]
    with pytest.raises(FileNotFoundError, match="1, 3"):
        tables.require_days(files, 4)


def test_absent_report(spark, tmp_path):
    assert tables.read_report(spark, str(tmp_path / "none")) is None
