"""Physical plans: what must reach the scan, and what must not appear."""

import contextlib
import io
import re

import pytest

from authweave.operators import alerts, clean, context, graph, profile, redteam
from authweave.plans import adapters, catalog
from authweave.schemas import AUTH_SCHEMA, PROCESS_SCHEMA, REDTEAM_SCHEMA
from authweave.sinks import writers
from authweave.sources import tables

FOLDER = "/root/testdata/sf0.001"
NO_WRITE = [
    name for name in catalog.queries()
    if name not in {"csv_roundtrip", "parquet_roundtrip", "clean_week", "day_replacement",
                    "size_per_day", "validation_checks", "cross_dataset_report", "triage",
                    "process_evidence", "evaluation", "validation_faults", "kept_output", "absent_days",
                    "day_files", "staged_days_report", "alert_documents", "streamed_clean", "streamed_contacts",
                    "kept_measures", "kept_validation", "user_incidents",
                    "node_structure", "adjacency_blocks", "spread_features"}
    and not name.endswith(("_roundtrip", "_csv"))
]


def plan(frame, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain(mode)
    return text.getvalue()


@pytest.mark.parametrize("name", NO_WRITE)
def test_no_nested_loops_no_python(spark, name):
    text = plan(catalog.queries()[name](spark, FOLDER))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "auth")
    adapters.auth_log(spark, FOLDER).drop("event_id").write.parquet(path)
    return spark.read.schema(AUTH_SCHEMA).parquet(path)


def test_cleaning_is_one_stage_with_pushed_null_test(raw):
    text = plan(clean.clean_auth(raw))
    assert "Exchange" not in text
    assert "IsNotNull(time)" in text


@pytest.mark.parametrize("name", ["auth_clean", "integrity_report", "redteam_preservation", "raw_match"])
def test_generated_methods_can_be_compiled(spark, name):
    """The JVM does not compile methods of 8000 bytes or more."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(catalog.queries()[name](spark, FOLDER), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8_000


def test_only_needed_columns_are_read(raw):
    text = plan(clean.clean_auth(raw).groupBy("day_index").count())
    assert "ReadSchema: struct<time:bigint,src_user:string,src_computer:string,dst_computer:string>" in text


def test_days_prune_partitions(spark, raw, tmp_path):
    path = str(tmp_path / "clean")
    writers.write_clean_table(clean.clean_auth(raw), path)
    text = plan(tables.read_clean_table(spark, path, 7).select("src_user"))
    assert "PartitionFilters" in text and "day_index" in text.split("PartitionFilters")[1][:200]
    assert "ReadSchema: struct<src_user:string>" in text


@pytest.fixture(scope="module")
def ordered_log(spark, tmp_path_factory):
    """200,000 rows in time order, in files of small row groups."""
    path = str(tmp_path_factory.mktemp("ordered") / "log")
    rows = spark.range(0, 200_000, 1, 4).selectExpr(
        "id AS time", "'U1' AS src_user", "'U1' AS dst_user", "'C1' AS src_computer", "'C2' AS dst_computer",
        "'' AS auth_type", "'' AS logon_type", "'' AS auth_orientation", "'Success' AS success",
        "'U1' AS user", "'C1' AS computer", "concat('P', id) AS process", "'Start' AS event_type")
    rows.write.option("parquet.block.size", 16_384).option("parquet.page.size", 1_024).option(
        "parquet.block.row.check.min", 100).parquet(path)
    return spark.read.parquet(path)


def rows_scanned(frame):
    """Rows that left the scans of a frame's files."""
    frame.write.format("noop").mode("overwrite").save()
    found, nodes = 0, [frame._jdf.queryExecution().executedPlan()]
    frame.collect()
    nodes = [frame._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
            continue
        if name.startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        if "QueryStage" in name:
            nodes.append(node.plan())
        nodes += [node.children().apply(k) for k in range(node.children().size())]
    return found


def test_bounds_of_events_reach_the_scan(spark, ordered_log):
    attacks = [(k, 100_000 + 100 * k, "U1", "C1", "C2") for k in range(5)]
    events = spark.createDataFrame(attacks, "redteam_id long, time long, user string, src_computer string, dst_computer string")
    process = ordered_log.select("time", "user", "computer", "process", "event_type")
    auth = ordered_log.select(*AUTH_SCHEMA.fieldNames())
    for frame, most in (
        (redteam.raw_matches(auth, events), 20_000),
        (redteam.matches_per_event(auth, events), 20_000),
        (context.process_context(events, process), 20_000),
        (profile.first_rows(auth, 50, AUTH_SCHEMA.fieldNames()[1:]), 20_000),
    ):
        assert 0 < rows_scanned(frame) <= most
    assert redteam.raw_matches(auth, events).count() == 5
    assert context.process_context(events, process).count() == 5 * 601


def test_days_of_events_prune_folders(spark, raw, tmp_path):
    path = str(tmp_path / "clean")
    writers.write_clean_table(clean.clean_auth(raw), path)
    events = spark.createDataFrame([(0, 3 * 86_400 + 5, "U1", "C1", "C2")], "event_id long, time long, user string, src_computer string, dst_computer string")
    text = plan(redteam.matches_per_event(tables.read_clean_table(spark, path), events))
    assert "PartitionFilters: [isnotnull(day_index" in text and "(day_index" in text and "= 3)" in text


@pytest.fixture
def events(spark):
    rows = [(1, 10, "U1", "C1", "C2")]
    return spark.createDataFrame(rows, "redteam_id long, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in REDTEAM_SCHEMA))


def test_small_attack_table_does_not_move_the_log(raw, events):
    text = plan(redteam.raw_matches(raw, events))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_large_sides_use_sort_merge(spark, raw, events, no_broadcast):
    process = spark.createDataFrame([(5, "U1", "C1", "P1", "End")], PROCESS_SCHEMA)
    cleaned = clean.clean_auth(raw)
    for frame in (
        redteam.raw_matches(raw, events),
        redteam.matches_per_event(raw, events),
        context.process_context(events, process),
        graph.label_rows(cleaned, events.drop("redteam_id")),
    ):
        text = plan(frame)
        assert "SortMergeJoin" in text
        assert "Broadcast" not in text


def test_hot_key_is_split(spark, no_broadcast):
    """With a third of the log on one key the join reads that partition in pieces."""
    settings = {
        "skewJoin.skewedPartitionThresholdInBytes": "20000",
        "skewJoin.skewedPartitionFactor": "1.5",
        "advisoryPartitionSizeInBytes": "20000",
        "coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(f"spark.sql.adaptive.{name}", value)
    try:
        log = spark.range(0, 90_000, 1, 8).selectExpr(
            "IF(id % 3 = 0, 1, id) AS time", "'U1' AS src_user", "hex(xxhash64(id)) AS dst_user",
            "'C1' AS src_computer", "'C2' AS dst_computer", "'' AS auth_type", "'' AS logon_type",
            "'' AS auth_orientation", "'' AS success")
        attacks = spark.range(1, 2_000).selectExpr("id AS redteam_id", "id AS time", "'U1' AS user", "'C1' AS src_computer", "'C2' AS dst_computer")
        found = redteam.raw_matches(log, attacks)
        rows = found.collect()
        text = plan(found)
    finally:
        for name in settings:
            spark.conf.unset(f"spark.sql.adaptive.{name}")
    assert len(rows) == 30_000 + sum(1 for i in range(1, 2_000) if i % 3)
    assert "skew=true" in text
