import gzip
import json

import pytest
from pyspark.sql import functions as F

from authweave.operators import clean
from authweave.plans import jobs
from authweave.schemas import AUTH_SCHEMA
from authweave.sinks import writers
from authweave.sources import raw_logs, tables
from authweave.streaming import clean_stream

DAY = 86_400
AUTH = [
    f"{t},U{t % 3}@DOM1,U{t % 3}@DOM1,C1,C{t % 4},NTLM,Network,LogOn,Success"
    for t in range(100, 2 * DAY, 4_000)
]
BAD = ["5,U1@DOM1,U1@DOM1,C1,C2", "x,U1@DOM1,U1@DOM1,C1,C2,NTLM,Network,LogOn,Success", ""]
LATER = [f"{3 * DAY},U1@DOM1,U1@DOM1,C1,C2,NTLM,Network,LogOn,Success"]
ATTACKS = ["100,u1@dom1 ,C1,C0", "4100,U2@DOM1,C1,C0", "broken", f"{3 * DAY},U1@DOM1,C1,C2"]
PROCESS = ["101,U1@DOM1,C0,P1,Start", "399,U9@DOM1,C0,P2,End", "4401,U2@DOM1,C0,P3,End",
           "4000,U2@DOM1,C1,P3,End", "9999,U2@DOM1,C1,P3,End", "1,2"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("logs")
    for name, rows in (("auth", AUTH[:20] + BAD + AUTH[20:] + LATER), ("red", ATTACKS), ("proc", PROCESS)):
        with gzip.open(path / f"{name}.csv.gz", "wt") as file:
            file.write("\n".join(rows) + "\n")
    return path


@pytest.fixture(scope="module")
def staged(spark, folder):
    jobs.stage_auth(spark, str(folder / "auth.csv.gz"), str(folder / "staged"), str(folder / "staging"), 2)
    return str(folder / "staged")


@pytest.fixture(scope="module")
def table(spark, folder, staged):
    jobs.clean_staged_days(spark, staged, str(folder / "clean"), str(folder / "cleaning"), 2)
    return str(folder / "clean")


def report(path):
    (part,) = path.glob("part-*.json")
    return json.loads(part.read_text())


def test_staging(spark, folder, staged):
    found = report(folder / "staging")
    assert found["total_valid_rows"] == len(AUTH)
    assert found["malformed_rows"] == 2  # Spark's reader skips the blank line
    assert (found["minimum_timestamp"], found["maximum_timestamp"]) == (100, 172_100)
    assert found["cutoff_seconds"] == 2 * DAY and found["number_of_days"] == 2
    per_day = {str(d): sum(1 for row in AUTH if int(row.split(",")[0]) // DAY == d) for d in (0, 1)}
    assert found["rows_per_day"] == per_day
    rows = raw_logs.well_formed(raw_logs.read_auth_log(spark, staged)).drop("day_index").collect()
    assert sorted(",".join(map(str, row)) for row in rows) == sorted(AUTH)


def test_existing_output_is_kept(spark, folder, staged):
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        jobs.stage_auth(spark, str(folder / "auth.csv.gz"), staged, str(folder / "again"), 2)


def test_cleaning(spark, folder, table):
    found = report(folder / "cleaning")
    assert len(found["generated_columns"]) == 16 and found["days_processed"] == 2
    assert [day["day"] for day in found["processed_days"]] == [0, 1]
    rows = tables.read_clean_table(spark, table)
    assert rows.count() == len(AUTH) and len(rows.columns) == 25


def test_cleaning_needs_every_day(spark, folder, staged):
    with pytest.raises(FileNotFoundError, match=r"\[2\]"):
        jobs.clean_staged_days(spark, staged, str(folder / "never"), str(folder / "never2"), 3)


def test_validation(spark, folder, table):
    jobs.validate_table(spark, table, str(folder / "red.csv.gz"), str(folder / "staging"),
                        str(folder / "preserved"), str(folder / "validation"), 2)
    found = report(folder / "validation")
    assert found["validation_status"] == "PASS" and all(found["checks"].values())
    assert len(found["checks"]) == 9
    assert found["schema"]["pass"] and found["schema"]["expected"] == found["schema"]["actual"]
    assert found["schema"]["missing_columns"] == [] and found["schema"]["type_mismatches"] == {}
    assert found["row_integrity"]["staged_rows"] == found["row_integrity"]["processed_rows"] == len(AUTH)
    assert found["row_integrity"]["daily_retention"]["1"]["retention_rate_percent"] == 100.0
    assert found["day_coverage"] == {"expected_days": [0, 1], "present_days": [0, 1], "pass": True}
    assert found["redteam_preservation"]["events_in_window"] == 2
    lines = "".join(p.read_text() for p in sorted((folder / "preserved").glob("part-*.csv")))
    assert "event_id,source_row,time,user,src_computer,dst_computer,processed_match_count,preserved" in lines
    assert "0,1,100,U1@DOM1,C1,C0,1,1" in lines and "1,2,4100,U2@DOM1,C1,C0,1,1" in lines


def test_validation_without_a_staging_report(spark, folder, table):
    jobs.validate_table(spark, table, str(folder / "red.csv.gz"), None,
                        str(folder / "preserved2"), str(folder / "validation2"), 2)
    found = report(folder / "validation2")
    assert found["checks"]["row_integrity"] and found["row_integrity"]["staged_rows"] is None
    assert found["row_integrity"]["daily_retention"] == {}


def test_cross_validation(spark, folder):
    jobs.cross_validate(
        spark, *(str(folder / f"{name}.csv.gz") for name in ("red", "auth", "proc")),
        str(folder / "matches"), str(folder / "context"), str(folder / "cross"), first=2)
    found = report(folder / "cross")
    assert found["redteam_events_tested"] == 2
    assert found["redteam_events_with_exact_auth_match"] == 1  # case and padding count here
    assert found["unmatched_redteam_ids"] == [1]
    assert found["exact_auth_match_rate_percent"] == 50.0
    assert found["auth_rows_scanned"] == 3 and found["process_rows_scanned"] == 4
    assert found["process_context_events_found"] == 3
    assert found["same_user_process_context_events"] == 1
    assert found["process_context_window_seconds"] == 300


def test_inspection(spark, folder):
    jobs.inspect_auth(spark, str(folder / "auth.csv.gz"), str(folder / "s1"), str(folder / "r1"), 10)
    auth = report(folder / "r1")
    assert auth["inspection_rows"] == 10 and auth["unique_source_users_in_sample"] == 3
    assert auth["schema"][0] == "time" and auth["missing_values_in_sample"]["success"] == 1
    jobs.inspect_process(spark, str(folder / "proc.csv.gz"), str(folder / "s2"), str(folder / "r2"), None)
    process = report(folder / "r2")
    assert process["inspection_rows"] == 6 and process["unique_processes_in_sample"] == 4
    jobs.inspect_redteam(spark, str(folder / "red.csv.gz"), str(folder / "s3"), str(folder / "r3"))
    red = report(folder / "r3")
    assert red["total_valid_events"] == 3 and red["malformed_rows"] == 1
    assert red["unique_users"] == 3 and red["maximum_timestamp"] == 3 * DAY


def test_replacing_a_day_keeps_the_others(spark, folder, table):
    copy = str(folder / "copy")
    rows = tables.read_clean_table(spark, table)
    writers.write_clean_table(rows, copy)
    writers.replace_days(rows.filter("day_index = 1").limit(1), copy, [1])
    counts = {r.day_index: r["count"] for r in tables.read_clean_table(spark, copy).groupBy("day_index").count().collect()}
    assert counts == {0: rows.filter("day_index = 0").count(), 1: 1}


def days_of(spark, path):
    return {r.day_index: r["count"] for r in tables.read_clean_table(spark, path).groupBy("day_index").count().collect()}


def test_a_day_that_becomes_empty_goes(spark, folder, table):
    copy = str(folder / "emptied")
    rows = tables.read_clean_table(spark, table)
    writers.write_clean_table(rows, copy)
    before = days_of(spark, copy)
    writers.replace_days(rows.filter("day_index = 1 AND time < 0"), copy, [1])
    assert days_of(spark, copy) == {0: before[0]}


def test_replacing_days_as_a_job(spark, folder, staged, table):
    copy = str(folder / "again")
    rows = tables.read_clean_table(spark, table)
    writers.write_clean_table(rows.filter("day_index = 0 OR time % 3 = 0"), copy)
    jobs.replace_cleaned_days(spark, staged, copy, [1])
    assert days_of(spark, copy) == days_of(spark, table)


def test_misplaced_days_fail_the_validation(spark, folder, tmp_path):
    extra = [f"{t},U1@DOM1,U1@DOM1,C1,C2,NTLM,Network,LogOn,Success" for t in (-5, 9 * DAY)]
    with gzip.open(tmp_path / "auth.csv.gz", "wt") as file:
        file.write("\n".join(AUTH + extra) + "\n")
    paths = {name: str(tmp_path / name) for name in ("staged", "staging", "clean", "cleaning", "found", "verdict", "bad", "verdict2")}
    jobs.stage_auth(spark, str(tmp_path / "auth.csv.gz"), paths["staged"], paths["staging"], 2)
    jobs.clean_staged_days(spark, paths["staged"], paths["clean"], paths["cleaning"], 2)
    assert report(tmp_path / "cleaning")["rows_outside_days"] == 1
    rows = tables.read_clean_table(spark, paths["clean"])
    wrong = rows.withColumn("day_index", F.expr("CASE WHEN time < 5000 THEN -1 WHEN time < 9000 THEN NULL ELSE day_index END"))
    writers.write_clean_table(wrong.select(*rows.columns), paths["bad"])
    jobs.validate_table(spark, paths["bad"], str(folder / "red.csv.gz"), None, paths["found"], paths["verdict"], 2)
    found = report(tmp_path / "verdict")
    assert found["validation_status"] == "FAIL"
    assert found["invalid_temporal_counts"]["day_index"] == 2 and found["critical_null_counts"]["day_index"] == 1
    assert found["logical_consistency_counts"]["day_time_mismatch"] == 2
    assert found["day_coverage"]["present_days"] == [-1, 0, 1] and not found["day_coverage"]["pass"]


@pytest.mark.parametrize("readers", [1, 8])
def test_a_large_day_is_split(spark, folder, table, readers):
    row = tables.read_clean_table(spark, table).limit(1)
    (values,) = row.collect()
    day = spark.range(0, 60_000, 1, readers).select(
        (F.col("id") % DAY).alias("time"), F.lit(0).alias("day_index"),
        F.hex(F.xxhash64("id")).alias("src_user"),
        *[F.lit(values[n]).alias(n) for n in row.columns if n not in ("time", "day_index", "src_user")],
    ).select(*row.columns)
    path = str(folder / f"split{readers}")
    sizes = {"advisoryPartitionSizeInBytes": "200000", "coalescePartitions.minPartitionSize": "1"}
    for name, size in sizes.items():
        spark.conf.set(f"spark.sql.adaptive.{name}", size)
    try:
        writers.write_clean_table(day, path)
    finally:
        for name in sizes:
            spark.conf.unset(f"spark.sql.adaptive.{name}")
    assert tables.list_day_files(spark, path).count() > 3
    assert tables.read_clean_table(spark, path).count() == 60_000


def test_a_staged_day_is_few_files(spark, folder):
    """However many tasks write: a stream pays a batch for every few files."""
    line = [F.lit("x").alias(n) for n in AUTH_SCHEMA.fieldNames() if n != "time"]
    rows = spark.range(0, 3 * DAY, 60).select(F.col("id").alias("time"), *line)
    path = str(folder / "few-files")
    confs = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in confs.items():
        spark.conf.set(name, value)
    try:
        writers.write_staged_days(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    files = tables.list_day_files(spark, path, "*.csv.gz").groupBy("day_index").count().collect()
    assert len(files) == 3 and all(f["count"] <= 4 for f in files)
    assert spark.read.csv(path).count() == 3 * DAY // 60


def test_stream_equals_batch(spark, folder, staged):
    out, state = str(folder / "streamed"), str(folder / "state")
    clean_stream.clean_new_files(spark, f"{staged}/*", out, state).awaitTermination()
    clean_stream.clean_new_files(spark, f"{staged}/*", out, state).awaitTermination()
    batch = clean.clean_auth(raw_logs.well_formed(raw_logs.read_auth_log(spark, staged)).drop("day_index"))
    streamed = tables.read_clean_table(spark, out)
    assert streamed.count() == batch.count() == len(AUTH)
    assert streamed.exceptAll(batch).count() == 0
    writers.replace_days(batch.filter("day_index = 1").limit(2), out, [1])
    assert days_of(spark, out) == {0: batch.filter("day_index = 0").count(), 1: 2}
