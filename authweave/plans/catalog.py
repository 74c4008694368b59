"""Registered queries: each takes (spark, folder of the test tables) and returns a DataFrame."""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authweave.operators import (
    alerts, behavior, blocks, clean, context, cores, drift, graph, heavy, incidents, profile, quality,
    redteam, staging,
)
from authweave.operators.ids import number_rows
from authweave.plans import adapters, jobs
from authweave.schemas import (
    AUTH_SCHEMA, AUTH_TEXT_COLUMNS, PROCESS_SCHEMA, REDTEAM_KEY, SECONDS_PER_DAY,
)
from authweave.sinks import measured, writers
from authweave.sources import lines, raw_logs, tables
from authweave.streaming import clean_stream
from authweave.workspace import new_path, pinned

Query = Callable[[SparkSession, str], DataFrame]

WEEK = 7
ALL_DAYS = 30
AUTH_COLUMNS = AUTH_SCHEMA.fieldNames()

auth = adapters.auth_log
process = adapters.process_log
attacks = adapters.redteam_log


def cleaned(spark, folder):
    return clean.clean_auth(auth(spark, folder))


def cleaned_keys(spark, folder):
    return clean.clean_keys(auth(spark, folder))


def numbered_attacks(spark, folder):
    return redteam.number_events(attacks(spark, folder))


# cleaning

def kept_fields(spark, folder):
    return auth(spark, folder).transform(clean.keep_critical).withColumns(clean.normalized_fields())


def norm_fields(spark, folder):
    return auth(spark, folder).withColumns(clean.normalized_fields())


def critical_filter(spark, folder):
    return kept_fields(spark, folder).select(
        "event_id", "time", "src_user", "dst_user", "src_computer", "dst_computer"
    )


def window_filter(spark, folder):
    return clean.before_day(auth(spark, folder), WEEK)


def time_parts(spark, folder):
    timed = auth(spark, folder).filter(F.col("time").isNotNull())
    return timed.withColumns(clean.time_parts()).select(
        "event_id", "time", "day_index", "second_of_day", "hour"
    )


def user_parts(spark, folder):
    return kept_fields(spark, folder).withColumns(clean.user_parts()).select(
        "event_id", "src_user", "src_user_account", "src_user_domain",
        "dst_user", "dst_user_account", "dst_user_domain",
    )


def result_flags(spark, folder):
    return norm_fields(spark, folder).withColumns(clean.result_flags()).select(
        "event_id", "success", "auth_orientation",
        "success_flag", "is_failure", "is_logon", "is_logoff",
    )


def account_flags(spark, folder):
    parts = kept_fields(spark, folder).withColumns(clean.user_parts())
    return parts.withColumns(clean.account_flags()).select(
        "event_id", "src_user_account", "src_is_machine_account",
        "dst_user_account", "dst_is_machine_account",
    )


def relation_flags(spark, folder):
    return kept_fields(spark, folder).withColumns(clean.relation_flags()).select(
        "event_id", "same_user", "same_computer", "cross_host"
    )


def daily_overview(spark, folder):
    return (
        cleaned(spark, folder).groupBy("day_index").agg(
            F.count("*").alias("rows"),
            F.sum(F.col("is_failure").cast("long")).alias("failures"),
            F.sum(F.col("cross_host").cast("long")).alias("cross_host_rows"),
        ).orderBy("day_index")
    )


# profiles

def time_range(spark, folder):
    logs = {"auth": auth, "process": process, "redteam": attacks}
    parts = [
        profile.time_range(log(spark, folder)).select(F.lit(name).alias("log"), "*")
        for name, log in logs.items()
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def profile_sample(spark, folder):
    log = auth(spark, folder).select(*AUTH_COLUMNS)
    return profile.first_rows(log, profile.SAMPLE_ROWS, AUTH_TEXT_COLUMNS)


def profile_sample_cut(spark, folder):
    """A cut below the size of the smallest test table."""
    log = auth(spark, folder).select(*AUTH_COLUMNS)
    return profile.first_rows(log, 500, AUTH_TEXT_COLUMNS)


def first_rows(spark, folder):
    log = process(spark, folder)
    return profile.first_rows(log, 10, PROCESS_SCHEMA.fieldNames()[1:])


# staging

def staging_from_csv(spark, folder):
    path = new_path(spark, "auth-lines")
    adapters.auth_lines(spark, folder).write.option("compression", "gzip").text(path)
    return staging.staging_report(raw_logs.read_auth_log(spark, path), ALL_DAYS)


def redteam_malformed(spark, folder):
    path = new_path(spark, "redteam-lines")
    adapters.redteam_lines(spark, folder).write.option("compression", "gzip").text(path)
    read = lines.read_redteam_lines(spark, path)
    timed = lines.valid_lines(read).agg(
        F.count("*").alias("total_valid_events"),
        F.count_if(F.col("time").isNull()).alias("missing_time"),
    )
    bad = lines.malformed_lines(read).agg(F.count("*").alias("n")).scalar()
    return timed.withColumn("malformed_rows", bad)


def process_from_csv(spark, folder):
    path = new_path(spark, "process-lines")
    adapters.process_lines(spark, folder).write.option("compression", "gzip").text(path)
    return raw_logs.well_formed(raw_logs.read_process_log(spark, path))


def redteam_malformed_lines(spark, folder):
    """Number and content of malformed lines of a log that is range-sorted into several files.

    A line's number counts on through the files in the order of their names.
    """
    path = new_path(spark, "redteam-lines")
    adapters.redteam_lines(spark, folder).orderBy("value").write.text(path)
    read = lines.read_redteam_lines(spark, path)
    numbered = number_rows(read, ["file", "source_row"], "line", 1)
    counted = numbered.withColumn("source_row", F.col("line"))
    return lines.malformed_lines(counted).select("line_number", "content")


def staged_days_report(spark, folder):
    """Rows per day out of the report that the staging job writes."""
    paths = [new_path(spark, name) for name in ("auth-lines", "staged", "staging-report")]
    adapters.auth_lines(spark, folder).write.option("compression", "gzip").text(paths[0])
    jobs.stage_auth(spark, *paths, days=ALL_DAYS)
    return tables.reported_days(tables.read_report(spark, paths[2]))


def report_roundtrip(spark, folder):
    path = new_path(spark, "report")
    writers.write_report(staging.staging_report(auth(spark, folder), WEEK), path)
    return tables.read_report(spark, path)


def report_presence(spark, folder):
    """Whether a report was found: one that was written and one that was not."""
    written = report_roundtrip(spark, folder).agg((F.count("*") == 1).alias("found"))
    absent = tables.read_report(spark, new_path(spark, "absent")) is not None
    return written.select(F.lit("written").alias("report"), "found").union(
        written.select(F.lit("absent"), F.lit(absent))
    )


def scan_counts(spark, folder):
    return staging.scan_counts(
        auth(spark, folder), process(spark, folder), attacks(spark, folder)
    )


# attacks

def match_count(spark, folder):
    counted = redteam.matches_per_event(auth(spark, folder), numbered_attacks(spark, folder))
    return counted.filter(F.col("matches") > 0).select("redteam_id", F.col("matches").alias("n"))


def preservation_summary(spark, folder):
    events = pinned(clean.before_day(attacks(spark, folder), WEEK))
    return redteam.preservation_summary(redteam.events_preserved(cleaned_keys(spark, folder), events))


def cross_dataset_report(spark, folder):
    """The first ten attacks against both logs."""
    events = pinned(redteam.first_events(attacks(spark, folder)))
    rate = redteam.match_rate(auth(spark, folder), events)
    missed = redteam.unmatched_events(auth(spark, folder), events).agg(
        F.array_join(F.array_sort(F.collect_list("redteam_id")), ",").alias("ids")
    )
    scans = pinned(staging.scan_counts(auth(spark, folder), process(spark, folder), events))
    near = pinned(context.context_summary(events, process(spark, folder)))
    return rate.withColumns({
        "unmatched_redteam_ids": missed.scalar(),
        **{name: scans.select(name).scalar() for name in scans.columns},
        **{name: near.select(name).scalar() for name in near.columns},
    })


# quality

def daily_retention(spark, folder):
    staged = staging.staged_rows(auth(spark, folder), ALL_DAYS)
    return staging.daily_retention(
        staging.rows_per_day(staged), staging.rows_per_day(cleaned(spark, folder)), ALL_DAYS
    )


def retention(spark, folder):
    return staging.retention(
        staging.staging_counts(auth(spark, folder), ALL_DAYS),
        cleaned(spark, folder).agg(F.count("*").alias("processed_rows")),
    )


def _written_table(spark, folder):
    """The clean table as files, written anew for each query that reads it."""
    path = new_path(spark, "auth-clean")
    writers.write_clean_table(cleaned(spark, folder), path)
    return path


def validation_checks(spark, folder):
    path = _written_table(spark, folder)
    table = tables.read_clean_table(spark, path)
    events = pinned(clean.before_day(attacks(spark, folder), ALL_DAYS))
    found = redteam.events_preserved(table, events)
    return quality.validation_checks(quality.measure(
        table, tables.list_day_files(spark, path), redteam.preservation_summary(found),
        staging.staging_counts(auth(spark, folder), ALL_DAYS), ALL_DAYS,
    ))


def validation_faults(spark, folder):
    """The checks over a written table with rows in wrong days."""
    path = new_path(spark, "auth-faulty")
    wrong = cleaned(spark, folder).withColumn("day_index", F.expr(adapters.WRONG_DAY).cast("int"))
    writers.write_clean_table(wrong, path)
    table = tables.read_clean_table(spark, path)
    measured = quality.measure(
        table, tables.list_day_files(spark, path),
        spark.range(1).select(F.lit(True).alias("pass")),
        staging.staging_counts(auth(spark, folder), ALL_DAYS), ALL_DAYS,
    )
    return quality.validation_checks(measured)


# files

def csv_roundtrip(spark, folder):
    path = new_path(spark, "auth-staged")
    rows = staging.staged_rows(auth(spark, folder).select(*AUTH_COLUMNS), ALL_DAYS)
    writers.write_staged_days(rows, path)
    return raw_logs.well_formed(raw_logs.read_auth_log(spark, path))


def parquet_roundtrip(spark, folder):
    return tables.read_clean_table(spark, _written_table(spark, folder))


def clean_week(spark, folder):
    return tables.read_clean_table(spark, _written_table(spark, folder), WEEK)


def day_replacement(spark, folder):
    """Days 0-6 are rewritten with failures only, day 3 with nothing; the other days stay."""
    path = new_path(spark, "auth-replaced")
    writers.write_clean_table(cleaned(spark, folder), path)
    failures = cleaned(spark, folder).filter((F.col("is_failure") == 1) & (F.col("day_index") != 3))
    writers.replace_days(failures, path, list(range(WEEK)))
    return staging.rows_per_day(tables.read_clean_table(spark, path))


def _replaced_measures(spark, folder):
    """The table of `day_replacement`, measured as it was written and then only where it changed."""
    path, kept = new_path(spark, "auth-measured"), new_path(spark, "measures")
    measured.write_table(cleaned(spark, folder), path, kept, ALL_DAYS)
    failures = cleaned(spark, folder).filter((F.col("is_failure") == 1) & (F.col("day_index") != 3))
    measured.replace_days(failures, path, kept, list(range(WEEK)), ALL_DAYS)
    return path, measured.read_measures(spark, kept)


def kept_measures(spark, folder):
    """Measures of the whole table, merged from the days after a replacement."""
    return quality.merged_measures(_replaced_measures(spark, folder)[1])


def kept_validation(spark, folder):
    """The checks over the kept measures: day 3 is gone, so coverage and files fail."""
    path, daily = _replaced_measures(spark, folder)
    passed = spark.range(1).select(F.lit(True).alias("pass"))
    return quality.validation_checks(quality.measure_from_days(
        daily, tables.read_clean_table(spark, path), tables.list_day_files(spark, path), passed,
        staging.staging_counts(auth(spark, folder), ALL_DAYS), ALL_DAYS,
    ))


def kept_output(spark, folder):
    """A second write to the same place is refused; what is there stays."""
    path = new_path(spark, "auth-kept")
    writers.write_clean_table(cleaned(spark, folder), path)
    try:
        writers.write_clean_table(cleaned(spark, folder).limit(1), path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    return staging.rows_per_day(tables.read_clean_table(spark, path))


def absent_days(spark, folder):
    path = new_path(spark, "auth-gap")
    writers.write_clean_table(cleaned(spark, folder).filter("day_index < 7 AND day_index <> 3"), path)
    return tables.missing_days(tables.list_day_files(spark, path), 10)


def day_files(spark, folder):
    """Whether each day has files, and bytes in them; sizes differ from run to run."""
    files = tables.list_day_files(spark, _written_table(spark, folder))
    return files.groupBy("day_index").agg(
        (F.count("*") > 0).alias("has_files"), (F.sum("length") > 0).alias("has_bytes")
    )


def _csv_again(frame, label):
    """Rows of a result table written as CSV and read back with its schema."""
    path = new_path(frame.sparkSession, label)
    writers.write_table_csv(frame, path)
    options = {**raw_logs.CSV_DIALECT, "header": True}
    return frame.sparkSession.read.schema(frame.schema).options(**options).csv(path)


def match_csv_roundtrip(spark, folder):
    return _csv_again(redteam.raw_matches(auth(spark, folder), numbered_attacks(spark, folder)), "matches")


def context_csv_roundtrip(spark, folder):
    near = context.process_context(numbered_attacks(spark, folder), process(spark, folder))
    return _csv_again(near, "context")


def preservation_csv_roundtrip(spark, folder):
    found = redteam.preservation(cleaned_keys(spark, folder), attacks(spark, folder), WEEK)
    return _csv_again(found, "preserved")


def _sample_again(log, columns):
    path = new_path(log.sparkSession, "sample")
    writers.write_sample_csv(log.select(*columns), path, 100, columns)
    schema = log.select(*columns).schema
    return log.sparkSession.read.schema(schema).options(**{**raw_logs.CSV_DIALECT, "header": True}).csv(path)


def auth_sample_csv(spark, folder):
    return _sample_again(auth(spark, folder), AUTH_COLUMNS)


def process_sample_csv(spark, folder):
    return _sample_again(process(spark, folder), PROCESS_SCHEMA.fieldNames())


def size_per_day(spark, folder):
    files = tables.list_day_files(spark, _written_table(spark, folder))
    return tables.size_per_day(files)


def redteam_sample(spark, folder):
    path = new_path(spark, "redteam-sample")
    writers.write_sample_csv(attacks(spark, folder), path, 20, REDTEAM_KEY)
    schema = "time bigint, user string, src_computer string, dst_computer string"
    return spark.read.schema(schema).options(**raw_logs.CSV_DIALECT).option("header", True).csv(path)


# streams

def _streamed(spark, folder, stream):
    """Runs a stream over the staged files of the later days, and again when the others have come.

    The second run goes on from the checkpoint of the first, several micro-batches each.
    """
    root, table, state = (new_path(spark, name) for name in ("staged-parts", "streamed", "stream-state"))
    rows = staging.staged_rows(auth(spark, folder).select(*AUTH_COLUMNS), ALL_DAYS)
    late = F.col("time") < ALL_DAYS // 2 * SECONDS_PER_DAY
    for part, chosen in (("first", ~late), ("late", late)):
        writers.write_staged_days(rows.filter(chosen), f"{root}/{part}")
        stream(spark, f"{root}/*/*", table, state, files_per_batch=6).awaitTermination()
    return table


def streamed_clean(spark, folder):
    return tables.read_clean_table(spark, _streamed(spark, folder, clean_stream.clean_new_files))


def streamed_contacts(spark, folder):
    return clean_stream.read_contacts(spark, _streamed(spark, folder, clean_stream.watch_contacts))


# behaviour, graph, alerts

def days_of(spark, folder):
    return behavior.daily_edges(cleaned(spark, folder))


def edges_of(spark, folder):
    return graph.edges(days_of(spark, folder))


def edge_index(spark, folder):
    table = cleaned(spark, folder)
    everyone = pinned(graph.nodes(table))
    return graph.edge_index(
        pinned(edges_of(spark, folder)), graph.node_index(everyone, graph.USER),
        graph.node_index(everyone, graph.HOST), WEEK,
    )


def scored_edges(spark, folder):
    return alerts.score_edges(pinned(edges_of(spark, folder)))


def flagged_edges(spark, folder):
    scored = scored_edges(spark, folder)
    limit = alerts.score_threshold(alerts.score_distribution(scored))
    return alerts.flag_scores(scored, limit)


def _edge_alerts(spark, folder):
    return pinned(alerts.edge_alerts(flagged_edges(spark, folder)))


def _evidence(spark, folder, found):
    named = process(spark, folder).withColumns(
        {name: F.upper(F.trim(F.col(name))) for name in ("user", "computer")}
    )
    contacts = alerts.alert_contacts(cleaned_keys(spark, folder), found)
    return context.process_evidence(contacts, named, alerts.ALERT)


def triage(spark, folder):
    found = _edge_alerts(spark, folder)
    return alerts.triage(found, _evidence(spark, folder, found))


def user_incidents(spark, folder):
    """Incidents of alerts at most six hours apart, their alerts as text, three to a row."""
    found = incidents.incidents(_edge_alerts(spark, folder), listed=3)
    return found.withColumn("listed", incidents.as_line(F.col("listed")))


def adjacency_blocks(spark, folder):
    """The entries of the block-sparse matrix, with the blocks they lie in."""
    matrix = blocks.adjacency(pinned(edge_index(spark, folder)))
    return blocks.entries_of(matrix).select("user_id", "host_id", F.round("weight", 6).alias("weight"))


def spread_features(spark, folder):
    """Per user the features of the hosts it reached, by the normalised adjacency."""
    names = ["users", "failed_share", "cross_host_share"]
    table = cleaned(spark, folder)
    hosts = graph.node_index(pinned(graph.nodes(table)), graph.HOST).withColumnRenamed("node", "dst_computer")
    features = blocks.host_features(edges_of(spark, folder)).join(hosts, "dst_computer")
    matrix = blocks.adjacency(pinned(edge_index(spark, folder)))
    found = blocks.spread_to_users(matrix, blocks.feature_blocks(features, "node_id", names), names)
    return found.select("user_id", *[F.round(name, 4).alias(name) for name in names])


def node_structure(spark, folder):
    everyone = pinned(graph.nodes(cleaned(spark, folder)))
    return cores.node_structure(everyone, pinned(edges_of(spark, folder)))


def alert_documents(spark, folder):
    return alerts.alert_documents(triage(spark, folder))


def _on(source: Query, operator, *arguments) -> Query:
    """A query that applies one operator to one derived table."""
    return lambda spark, folder: operator(source(spark, folder), *arguments)


def queries() -> dict[str, Query]:
    pinned_attacks = lambda spark, folder: pinned(attacks(spark, folder))
    activity = _on(cleaned, behavior.user_activity)
    return {
        "daily_overview": daily_overview,
        "auth_clean": cleaned,
        "norm_fields": norm_fields,
        "critical_filter": critical_filter,
        "window_filter": window_filter,
        "time_parts": time_parts,
        "user_parts": user_parts,
        "result_flags": result_flags,
        "account_flags": account_flags,
        "relation_flags": relation_flags,
        "auth_missing": _on(auth, profile.missing_values, AUTH_COLUMNS),
        "proc_missing": _on(process, profile.missing_values, PROCESS_SCHEMA.fieldNames()),
        "redteam_missing": _on(attacks, profile.missing_values, REDTEAM_KEY),
        "auth_entities": _on(
            auth, profile.distinct_values,
            ["src_user", "dst_user", "src_computer", "dst_computer"], True,
        ),
        "proc_entities": _on(
            process, profile.distinct_values, ["user", "computer", "process"], True
        ),
        "redteam_entities": _on(attacks, profile.distinct_values, REDTEAM_KEY[1:], False),
        "dist_success": _on(auth, profile.frequencies, "success"),
        "dist_auth_type": _on(auth, profile.frequencies, "auth_type"),
        "dist_logon_type": _on(auth, profile.frequencies, "logon_type"),
        "dist_event_type": _on(process, profile.frequencies, "event_type"),
        "top_processes": _on(process, profile.most_frequent, "process", 15),
        "top_users": _on(process, profile.most_frequent, "user", 10),
        "top_computers": _on(process, profile.most_frequent, "computer", 10),
        "heavy_processes": _on(process, heavy.top_values, "process", 15),
        "heavy_users": _on(process, heavy.top_values, "user", 10),
        "heavy_computers": _on(process, heavy.top_values, "computer", 10),
        "time_range": time_range,
        "profile_sample": profile_sample,
        "profile_sample_cut": profile_sample_cut,
        "first_rows": first_rows,
        "process_from_csv": process_from_csv,
        "redteam_malformed_lines": redteam_malformed_lines,
        "staged_days_report": staged_days_report,
        "report_roundtrip": report_roundtrip,
        "report_presence": report_presence,
        "validation_faults": validation_faults,
        "kept_output": kept_output,
        "kept_measures": kept_measures,
        "kept_validation": kept_validation,
        "absent_days": absent_days,
        "day_files": day_files,
        "match_csv_roundtrip": match_csv_roundtrip,
        "context_csv_roundtrip": context_csv_roundtrip,
        "preservation_csv_roundtrip": preservation_csv_roundtrip,
        "auth_sample_csv": auth_sample_csv,
        "process_sample_csv": process_sample_csv,
        "staging_counts": _on(auth, staging.staging_counts, WEEK),
        "staging_report": _on(auth, staging.staging_report, WEEK),
        "staging_from_csv": staging_from_csv,
        "redteam_malformed": redteam_malformed,
        "rows_per_day": _on(cleaned, staging.rows_per_day),
        "scan_counts": scan_counts,
        "first_redteam": _on(attacks, redteam.first_events),
        "raw_match": lambda spark, folder: redteam.raw_matches(
            auth(spark, folder), numbered_attacks(spark, folder)
        ),
        "match_count": match_count,
        "match_rate": lambda spark, folder: redteam.match_rate(
            auth(spark, folder), pinned_attacks(spark, folder)
        ),
        "unmatched_redteam": lambda spark, folder: redteam.unmatched_events(
            auth(spark, folder), numbered_attacks(spark, folder)
        ),
        "redteam_preservation": lambda spark, folder: redteam.preservation(
            cleaned_keys(spark, folder), attacks(spark, folder), WEEK
        ),
        "preservation_summary": preservation_summary,
        "process_context": lambda spark, folder: context.process_context(
            numbered_attacks(spark, folder), process(spark, folder)
        ),
        "context_summary": lambda spark, folder: context.context_summary(
            pinned_attacks(spark, folder), process(spark, folder)
        ),
        "cross_dataset_report": cross_dataset_report,
        "integrity_report": _on(cleaned, quality.integrity_report, ALL_DAYS),
        "schema_diff": _on(auth, quality.schema_report),
        "daily_retention": daily_retention,
        "retention": retention,
        "validation_checks": validation_checks,
        "csv_roundtrip": csv_roundtrip,
        "parquet_roundtrip": parquet_roundtrip,
        "clean_week": clean_week,
        "day_replacement": day_replacement,
        "size_per_day": size_per_day,
        "redteam_sample": redteam_sample,
        "streamed_clean": streamed_clean,
        "streamed_contacts": streamed_contacts,
        "user_activity": activity,
        "user_host_history": _on(days_of, behavior.user_host_history),
        "unique_hosts": _on(days_of, behavior.unique_hosts),
        "first_contacts": _on(days_of, behavior.first_contacts),
        "new_hosts": _on(days_of, behavior.new_hosts),
        "cross_host_activity": _on(activity, behavior.cross_host_activity),
        "login_hours": _on(cleaned, behavior.login_hours),
        "baselines": _on(activity, behavior.baselines),
        "hour_drift": lambda spark, folder: drift.hour_drift(drift.hour_histograms(cleaned(spark, folder))),
        "robust_baselines": lambda spark, folder: drift.robust_baselines(
            drift.daily_sketches(cleaned(spark, folder))
        ),
        "exact_baselines": _on(cleaned, drift.exact_baselines),
        "trailing_hosts": _on(days_of, drift.trailing_hosts),
        "trailing_hosts_estimated": lambda spark, folder: drift.trailing_hosts_estimated(
            drift.host_sketches(days_of(spark, folder))
        ),
        "redteam_labels": lambda spark, folder: graph.label_rows(
            cleaned_keys(spark, folder), pinned_attacks(spark, folder)
        ),
        "graph_nodes": _on(cleaned, graph.nodes),
        "graph_edges": edges_of,
        "node_index": lambda spark, folder: graph.node_index(
            graph.nodes(cleaned(spark, folder)), graph.USER
        ),
        "edge_index": edge_index,
        "node_features": _on(edges_of, graph.node_features),
        "ranked_anomalies": _on(scored_edges, alerts.ranked_anomalies),
        "score_distribution": _on(scored_edges, alerts.score_distribution),
        "score_threshold": lambda spark, folder: alerts.score_threshold(
            alerts.score_distribution(scored_edges(spark, folder))
        ),
        "evaluation": lambda spark, folder: alerts.evaluate(
            flagged_edges(spark, folder), pinned_attacks(spark, folder)
        ),
        "process_evidence": lambda spark, folder: _evidence(
            spark, folder, _edge_alerts(spark, folder)
        ),
        "user_incidents": user_incidents,
        "node_structure": node_structure,
        "host_features": _on(edges_of, blocks.host_features),
        "adjacency_blocks": adjacency_blocks,
        "spread_features": spread_features,
        "triage": triage,
        "alert_documents": alert_documents,
    }
