"""Behaviour of a user's day against the days before it, from parts that merge.

Per user and day a fixed-size part is kept: an hour histogram, a quantile sketch, a distinct
sketch. The trailing window merges parts, never rows: windows see one row per user and
day, whatever a user's share of all rows is.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from authweave.operators.behavior import BASELINE_DAYS

HOURS = 24
QUANTILE_K = 1024  # items of a quantile sketch; up to as many values it is exact
DISTINCT_LOG = 12  # 2^12 hashes of a distinct sketch; below as many values it is exact


def _before(days: int, until: int = -1):
    return Window.partitionBy("src_user").orderBy("day_index").rangeBetween(-days, until)


# hours

def hour_histograms(clean: DataFrame) -> DataFrame:
    """(src_user, day_index, logons, h0..h23): logons per hour of each user and day with any."""
    hours = clean.filter(F.col("is_logon") == 1).groupBy("src_user", "day_index", "hour").agg(
        F.count("*").alias("n")
    )
    counts = [
        F.sum(F.when(F.col("hour") == hour, F.col("n")).otherwise(0)).alias(f"h{hour}") for hour in range(HOURS)
    ]
    return hours.groupBy("src_user", "day_index").agg(F.sum("n").alias("logons"), *counts)


def _shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda n: n / total)


def _entropy(shares: Column) -> Column:
    """In bits; an hour without logons adds nothing."""
    bits = F.transform(shares, lambda p: F.when(p > 0, -p * F.log2(p)).otherwise(0.0))
    return F.aggregate(bits, F.lit(0.0), lambda total, one: total + one)


def hour_drift(histograms: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """Each day's hours against the merged hours of the `days` days before it.

    `entropy` tells how spread a day's logons are: 0 for one hour, log2(24) for all alike.
    `js_distance` is the square root of the Jensen-Shannon divergence in bits: 0 for the
    same shares, 1 for no hour in common, null without a logon in the days before.
    """
    names = [f"h{hour}" for hour in range(HOURS)]
    merged = histograms.select(
        "src_user", "day_index", "logons", F.array(*names).alias("hours"),
        F.sum("logons").over(_before(days)).alias("baseline_logons"),
        F.array(*[F.sum(name).over(_before(days)) for name in names]).alias("baseline"),
    )
    known = F.col("baseline_logons").isNotNull()
    shares = merged.withColumn("p", _shares(F.col("hours"), F.col("logons"))).withColumn(
        "q", F.when(known, _shares(F.col("baseline"), F.col("baseline_logons")))
    )
    middle = F.zip_with("p", "q", lambda p, q: (p + q) / 2)
    divergence = _entropy(middle) - (_entropy(F.col("p")) + _entropy(F.col("q"))) / 2
    return shares.select(
        "src_user", "day_index", "logons",
        F.size(F.filter("hours", lambda n: n > 0)).alias("active_hours"),
        F.round(_entropy(F.col("p")), 6).alias("entropy"),
        F.coalesce("baseline_logons", F.lit(0).cast("long")).alias("baseline_logons"),
        F.when(known, F.round(F.sqrt(F.greatest(divergence, F.lit(0.0))), 6)).alias("js_distance"),
    )


# quantiles

def daily_sketches(clean: DataFrame, value: str = "second_of_day", k: int = QUANTILE_K) -> DataFrame:
    """(src_user, day_index, n, sketch): a quantile sketch of a whole number per user and day."""
    known = clean.filter(F.col(value).isNotNull())
    return known.groupBy("src_user", "day_index").agg(
        F.count("*").alias("n"), F.kll_sketch_agg_bigint(F.col(value).cast("long"), k).alias("sketch")
    )


def _quantile(sketch: Column, rank: float) -> Column:
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(rank))


def _against(days: DataFrame) -> DataFrame:
    """Median of the day beside quartiles of the days before; deviation in quartile ranges."""
    spread = F.col("baseline_p75") - F.col("baseline_p25")
    return days.select(
        "src_user", "day_index", "n", "median",
        F.coalesce("baseline_n", F.lit(0).cast("long")).alias("baseline_n"),
        "baseline_p25", "baseline_median", "baseline_p75", spread.alias("baseline_spread"),
        F.round(F.try_divide(F.col("median") - F.col("baseline_median"), spread), 6).alias("deviation"),
        "exact",
    )


def robust_baselines(
    sketches: DataFrame, days: int = BASELINE_DAYS, k: int = QUANTILE_K
) -> DataFrame:
    """Median of each day against median and quartile range of the `days` days before.

    A quantile is the least value with at least that share of all values at or below it. The
    days' sketches are merged, never their rows. Up to k values, of the day and of the days before,
    the result is exact, and `exact` says so; above, the rank of a quantile is off by
    some 0.3 % of the values for k = 1024. `exact_baselines` has no such bound. The baseline is
    null without a value before; the deviation also without any spread.
    """
    merged = sketches.select(
        "src_user", "day_index", "n", "sketch",
        F.sum("n").over(_before(days)).alias("baseline_n"),
        F.kll_merge_agg_bigint("sketch", k).over(_before(days)).alias("before"),
    )
    before = F.when(F.col("baseline_n").isNotNull(), F.col("before"))
    return _against(merged.select(
        "src_user", "day_index", "n", "baseline_n", _quantile(F.col("sketch"), 0.5).alias("median"),
        _quantile(before, 0.25).alias("baseline_p25"), _quantile(before, 0.5).alias("baseline_median"),
        _quantile(before, 0.75).alias("baseline_p75"),
        (F.greatest("n", F.coalesce("baseline_n", F.lit(0))) <= k).alias("exact"),
    ))


def exact_baselines(
    clean: DataFrame, value: str = "second_of_day", days: int = BASELINE_DAYS
) -> DataFrame:
    """What `robust_baselines` approaches, for any number of values.

    Rows shrink to counts per value first. Each count serves the day it belongs to and, as
    part of their baseline, the user's active days after it: `days` + 1 rows at most. Places
    within the sorted values come from running sums per user and day.
    """
    counts = clean.filter(F.col(value).isNotNull()).groupBy(
        "src_user", "day_index", F.col(value).cast("long").alias("value")
    ).agg(F.count("*").alias("n"))
    active = counts.select("src_user", "day_index").distinct()
    ahead = counts.select(
        "src_user", "value", "n", F.col("day_index").alias("from"),
        F.explode(F.sequence(F.col("day_index"), F.col("day_index") + days)).alias("day_index"),
    ).join(active, ["src_user", "day_index"])
    own = F.col("from") == F.col("day_index")
    merged = ahead.groupBy("src_user", "day_index", own.alias("own"), "value").agg(F.sum("n").alias("n"))
    part = Window.partitionBy("src_user", "day_index", "own")
    placed = merged.select(
        "*", F.sum("n").over(part).alias("total"),
        F.sum("n").over(part.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
    )

    def at(rank: float, own: bool) -> Column:
        enough = (F.col("upto") >= F.ceil(F.lit(rank) * F.col("total"))) & (F.col("own") == F.lit(own))
        return F.min(F.when(enough, F.col("value")))

    return _against(placed.groupBy("src_user", "day_index").agg(
        F.max(F.when(F.col("own"), F.col("total"))).alias("n"),
        F.max(F.when(~F.col("own"), F.col("total"))).alias("baseline_n"),
        at(0.5, True).alias("median"), at(0.25, False).alias("baseline_p25"),
        at(0.5, False).alias("baseline_median"), at(0.75, False).alias("baseline_p75"),
    ).withColumn("exact", F.lit(True)))


# distinct hosts

def host_sketches(edges_by_day: DataFrame) -> DataFrame:
    """(src_user, day_index, hosts, sketch): a distinct sketch of the hosts of each user and day."""
    return edges_by_day.groupBy("src_user", "day_index").agg(
        F.count("*").alias("hosts"), F.theta_sketch_agg("dst_computer", DISTINCT_LOG).alias("sketch")
    )


def trailing_hosts_estimated(sketches: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """Distinct hosts of each user's day and of the `days` days that end with it.

    The days' sketches are united. Below 2^DISTINCT_LOG hosts the number is exact; above, its
    standard error is some 1.6 %. `trailing_hosts` counts exactly.
    """
    united = F.theta_union_agg("sketch", DISTINCT_LOG).over(_before(days - 1, 0))
    return sketches.select(
        "src_user", "day_index", "hosts", united.alias("united")
    ).select("src_user", "day_index", "hosts", F.theta_sketch_estimate("united").alias("trailing_hosts"))


def trailing_hosts(edges_by_day: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """The exact numbers, by the days over which a visit counts.

    A visit counts from its day on, until the user comes to the host again or the window has
    passed: so a host counts once on any day. That makes a step up on the one day and a step
    down on the other, and the number of a day is the sum of the steps up to it.
    """
    visits = Window.partitionBy("src_user", "dst_computer").orderBy("day_index")
    until = F.least(F.lead("day_index").over(visits), F.col("day_index") + days)  # a null is passed over
    spans = edges_by_day.select("src_user", "day_index", until.alias("until"))
    steps = spans.select("src_user", F.inline(F.array(
        F.struct("day_index", F.lit(1).alias("step"), F.lit(1).alias("host")),
        F.struct(F.col("until").alias("day_index"), F.lit(-1).alias("step"), F.lit(0).alias("host")),
    ))).groupBy("src_user", "day_index").agg(F.sum("step").alias("step"), F.sum("host").alias("hosts"))
    so_far = Window.partitionBy("src_user").orderBy("day_index").rowsBetween(Window.unboundedPreceding, 0)
    return steps.select(
        "src_user", "day_index", "hosts", F.sum("step").over(so_far).alias("trailing_hosts")
    ).filter("hosts > 0")
