"""Scores, thresholds, evaluation against known attacks, and alerts for triage."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authweave.functions.flags import flag
from authweave.operators.ids import number_rows, running_total
from authweave.operators.redteam import normalize_events
from authweave.operators.sizing import join_checked
from authweave.workspace import pinned

EDGE = ["src_user", "dst_computer"]
ALERT = ["user", "dst_computer"]
TOP_ANOMALIES = 20
THRESHOLD_SHARE = 0.95


def score_edges(edge_table: DataFrame) -> DataFrame:
    """Score of an edge: the share of its user's activity that goes to other hosts.

    `edge_table` is read twice and should be pinned. One row per user is joined back.
    """
    totals = pinned(edge_table.groupBy("src_user").agg(F.sum("auth_count").alias("user_total")))
    scored = join_checked(edge_table, totals, ["src_user"], "inner")
    share = F.col("auth_count") / F.col("user_total")
    return scored.withColumn("score", F.round(1 - share, 6)).drop("user_total")


def ranked_anomalies(scored: DataFrame, count: int = TOP_ANOMALIES) -> DataFrame:
    """The highest scores, ties in name order."""
    return scored.orderBy(F.desc("score"), *EDGE).limit(count)


def score_distribution(scored: DataFrame) -> DataFrame:
    """Per score value: rows, rank (1 = lowest), percent rank, rows up to and including it.

    Works on distinct scores, so a value shared by many rows is one row.
    """
    counts = scored.groupBy("score").agg(F.count("*").alias("rows"))
    summed = running_total(counts, ["score"], "rows", "rows_so_far")
    total = summed.agg(F.sum("rows").alias("total")).scalar()
    rank = F.col("rows_so_far") - F.col("rows") + 1
    return summed.select(
        "score", "rows", rank.alias("rank"),
        F.round(F.coalesce(F.try_divide(rank - 1, total - 1), F.lit(0.0)), 6).alias("percent_rank"),
        "rows_so_far",
    )


def score_threshold(distribution: DataFrame, share: float = THRESHOLD_SHARE) -> DataFrame:
    """One row: the smallest score that at least `share` of all rows do not exceed."""
    total = distribution.agg(F.sum("rows").alias("total")).scalar()
    reached = distribution.filter(F.col("rows_so_far") >= F.ceil(F.lit(share) * total))
    return reached.agg(
        F.min("score").alias("threshold"), F.max("rows_so_far").alias("scored_rows")
    )


def flag_scores(scored: DataFrame, threshold: DataFrame) -> DataFrame:
    limit = threshold.select("threshold").scalar()
    return scored.withColumn("flagged", flag(F.col("score") >= limit))


def evaluate(flagged: DataFrame, redteam: DataFrame) -> DataFrame:
    """One row: confusion counts and rates of flagged edges against attacked edges.

    An attacked pair without an edge is an attack that was missed.
    """
    attacked = normalize_events(redteam).select(
        F.col("user").alias("src_user"), "dst_computer"
    ).distinct().withColumn("_attack", F.lit(True))
    judged = flagged.select(*EDGE, "flagged").join(attacked, EDGE, "full")
    hit = F.coalesce(F.col("flagged") == 1, F.lit(False))
    attack = F.col("_attack").isNotNull()
    counts = judged.agg(
        F.count_if(hit & attack).alias("true_positives"),
        F.count_if(hit & ~attack).alias("false_positives"),
        F.count_if(~hit & attack).alias("false_negatives"),
        F.count_if(~hit & ~attack).alias("true_negatives"),
    )
    tp, fp = F.col("true_positives"), F.col("false_positives")
    fn, tn = F.col("false_negatives"), F.col("true_negatives")

    def rate(part, whole):
        return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)), 6)

    return counts.select(
        "*",
        rate(tp, tp + fp).alias("precision"),
        rate(tp, tp + fn).alias("recall"),
        rate(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        rate(tp, tp + fn).alias("detection_rate"),
        rate(fp, fp + tn).alias("false_positive_rate"),
    )


def edge_alerts(flagged: DataFrame) -> DataFrame:
    """Flagged edges as alerts by user and destination host, with the time of the first contact."""
    return flagged.filter(F.col("flagged") == 1).select(
        F.col("first_time").alias("time"),
        F.col("src_user").alias("user"),
        "dst_computer", "score", "auth_count", "failed_count", "cross_host_count",
    )


def alert_contacts(clean: DataFrame, alerts: DataFrame) -> DataFrame:
    """The rows of the clean table behind the alerts: user, time and both hosts."""
    rows = clean.select(F.col("src_user").alias("user"), "time", "src_computer", "dst_computer")
    return join_checked(rows, alerts.select(*ALERT), ALERT, "left_semi")


def triage(alerts: DataFrame, evidence: DataFrame) -> DataFrame:
    """Alerts with severity, priority and the evidence as counts.

    One point each for failures, cross-host use, process activity nearby and process
    activity by the same user. Priority 1 is the most urgent.
    """
    found = alerts.join(evidence, ALERT, "left")
    counts = ["process_events", "same_user_process_events", "distinct_processes"]
    filled = found.na.fill(0, counts)
    signals = ["failed_count", "cross_host_count", "process_events", "same_user_process_events"]
    risk = sum((flag(F.col(name) > 0) for name in signals), F.lit(0))
    severity = (
        F.when(F.col("risk") == 4, "critical").when(F.col("risk") == 3, "high")
        .when(F.col("risk") == 2, "medium").otherwise("low")
    )
    rated = filled.withColumn("risk", risk).withColumn("severity", severity)
    order = [F.desc("risk"), F.desc("score"), F.asc("user"), F.asc("dst_computer")]
    return number_rows(rated, order, "priority", 1).select(
        "priority", "severity", "risk", "time", "user", "dst_computer", "score",
        "auth_count", "failed_count", "cross_host_count", *counts,
        "first_process_time", "last_process_time",
    )


def alert_documents(triaged: DataFrame) -> DataFrame:
    """One JSON document per alert, empty fields included."""
    document = F.to_json(F.struct(*triaged.columns), {"ignoreNullFields": "false"})
    return triaged.select("priority", document.alias("alert"))
