"""Data behind the dashboard pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake import constants as C
from triagelake.functions import scalars as S
from triagelake.session import materialise

# --- totals from the monthly mart -----------------------------------------------


def kpis(ops: DataFrame) -> DataFrame:
    """Totals and shares; the mean of the medians is not weighted."""
    total = F.sum("total_issues")

    def of(kind: str) -> Column:
        return S.pct(F.sum(F.when(F.col("issuetype") == kind, F.col("total_issues"))), total, 1)

    return ops.agg(
        total.alias("total_issues"), F.sum("total_resolved").alias("total_resolved"),
        S.pct(F.sum("total_resolved"), total, 1).alias("pct_resolved"),
        S.round_half_up(F.avg("median_resolution_days"), 1).alias("avg_median_resolution_days"),
        of("Bug").alias("pct_bug"), of("Improvement").alias("pct_improvement"),
    )


def monthly_trend(ops: DataFrame) -> DataFrame:
    return ops.select("month", "issuetype", "total_issues").orderBy("month", "issuetype")


def totals_by_type(ops: DataFrame) -> DataFrame:
    return ops.groupBy("issuetype").agg(F.sum("total_issues").alias("n"))


def resolution_totals(ops: DataFrame) -> DataFrame:
    """Class totals rebuilt from the rounded shares, so only approximately whole."""
    def rebuilt(share: str) -> Column:
        return F.sum(F.col(share) * F.col("total_issues") / 100.0)

    return ops.agg(
        rebuilt("pct_fixed").alias("fixed"), rebuilt("pct_wontfix").alias("wontfix"),
        rebuilt("pct_duplicate").alias("duplicate"),
        rebuilt("pct_cannot_reproduce").alias("cannot_reproduce"),
        F.sum("total_issues").alias("total"),
    )


# --- cleaned issues --------------------------------------------------------------


def type_by_resolution(issues: DataFrame) -> DataFrame:
    return issues.groupBy("issuetype", "resolution").agg(F.count("*").alias("n"))


def type_by_resolution_matrix(issues: DataFrame) -> DataFrame:
    """Known resolutions as columns: no extra pass to discover them."""
    return issues.groupBy("issuetype").pivot("resolution", C.RESOLUTIONS).count().na.fill(0)


def resolution_times(issues: DataFrame, cap: int = 365) -> DataFrame:
    return issues.where(F.col("resolution_days").isNotNull() & F.col("resolved_at").isNotNull()).select(
        "key", "issuetype", "priority", "resolution", F.year("created_at").alias("year_created"),
        F.least("resolution_days", F.lit(cap)).alias("days"),
    )


def selected(
    times: DataFrame, types: Sequence[str] | None = None, priorities: Sequence[str] | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    if types is not None:
        times = times.where(F.col("issuetype").isin(list(types)))
    if priorities is not None:
        times = times.where(F.col("priority").isin(list(priorities)))
    if years is not None:
        times = times.where(F.col("year_created").between(*years))
    return times


def box_stats(times: DataFrame, by: str, value: str = "days") -> DataFrame:
    """Quartiles, extremes and 1.5 IQR whiskers per group. Rows are first counted
    per (group, day number), so both passes read a small table."""
    counts = times.groupBy(by, value).agg(F.count("*").alias("_n"))
    marks = counts.groupBy(by).agg(
        F.percentile(value, [0.0, 0.25, 0.5, 0.75, 1.0], F.col("_n")).alias("_p"), F.sum("_n").alias("n")
    )
    p = [F.col("_p")[i] for i in range(5)]
    fence = 1.5 * (p[3] - p[1])
    inside = F.col(value).between(p[1] - fence, p[3] + fence)
    return counts.join(marks, by).groupBy(by, "n", "_p").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
    ).select(
        by, "n", p[0].alias("low"), p[1].alias("q1"), p[2].alias("median"), p[3].alias("q3"),
        p[4].alias("high"), "whisker_low", "whisker_high",
    )


def histogram(times: DataFrame, value: str = "days", bins: int = 50) -> DataFrame:
    """At most ``bins`` bins of equal width between the extremes: bin, low edge, n.
    Counted per value first, so the extremes come from the small table too."""
    counts = times.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n"))
    ends = counts.agg(F.struct(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))).scalar()
    lo, hi = ends["lo"], ends["hi"]
    width = F.when(hi > lo, (hi - lo) / bins).otherwise(1.0)
    place = F.least(F.floor((F.col(value) - lo) / width), F.lit(bins - 1).cast("bigint"))
    return counts.groupBy(place.alias("bin")).agg(F.sum("_n").alias("n")).withColumn(
        "low_edge", S.round_half_up(lo + F.col("bin") * width, 6)
    )


# --- workload and links --------------------------------------------------------------


def busiest(workload: DataFrame, least: int = 5, n: int = 20) -> DataFrame:
    return (
        workload.where(F.col("n_assigned") >= least)
        .select("assignee", "n_assigned", "n_fixed", "avg_resolution_days",
                F.col("top_issuetype").alias("dominant_issuetype"))
        .orderBy(F.desc("n_assigned"), "assignee")
        .limit(n)
    )


def count_of_counts(changes: DataFrame, column: str = "n_assignee_changes") -> DataFrame:
    return changes.groupBy(column).agg(F.count("*").alias("n_tickets"))


def top_linked(links: DataFrame, issues: DataFrame, column: str, n: int = 20) -> DataFrame:
    """Tickets with most links of a kind. Cut to n before the join would be wrong
    where a key has no issue row, so the inner join comes first; both sides hold one
    row per key."""
    return (
        links.where(F.col(column) > 0).select("key", column)
        .join(issues.select("key", "issuetype", "resolution", S.excerpt(F.col("summary"), 80).alias("summary_excerpt")), "key")
        .orderBy(F.desc(column), "key")
        .limit(n)
    )


def link_totals(links: DataFrame) -> DataFrame:
    """Totals per kind from one scan, then unpivoted."""
    kinds = [("Duplicate", "n_duplicates"), ("Blocks", "n_blocks"),
             ("Blocked By", "n_blocked_by"), ("Relates", "n_relates")]
    sums = links.agg(*[F.sum(c).alias(name) for name, c in kinds])
    return sums.unpivot([], [name for name, _ in kinds], "type_name", "n_links")


# --- anomalies ------------------------------------------------------------------------


def _churn() -> Column:
    return S.flag((F.col("n_status_changes") > 5) | (F.col("n_assignee_changes") > 3))


def _reversed() -> Column:
    return S.flag((F.col("was_escalated") == 1) & (F.col("was_deescalated") == 1))


def _crowd() -> Column:
    return S.flag(F.col("n_people_involved") > 5)


def anomaly_base(changes: DataFrame, issues: DataFrame) -> DataFrame:
    mine = issues.select("key", "issuetype", "resolution", "priority", "created_at", "resolution_days", "summary")
    return changes.join(mine, "key").select(
        "key", "issuetype", "resolution", "priority", "created_at",
        F.year("created_at").alias("year_created"),
        F.least("resolution_days", F.lit(5000)).alias("resolution_days"),
        "n_status_changes", "n_assignee_changes", "n_priority_changes", "n_people_involved",
        "was_escalated", "was_deescalated", S.excerpt(F.col("summary"), 100).alias("summary_excerpt"),
        _churn().alias("flag_high_churn"), _reversed().alias("flag_escalation_reversed"),
        _crowd().alias("flag_many_people"),
    )


def group_quantile(rows: DataFrame, by: str, value: str, q: float, name: str) -> DataFrame:
    """Interpolated quantile per group, from counts per (group, value)."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(by).agg(F.percentile(value, q, F.col("_n")).alias(name))


def anomalies(changes: DataFrame, issues: DataFrame) -> DataFrame:
    """Base rows plus p99 of their type and the outlier flag. The base is stored (a job):
    it feeds the quantiles, too. Types are the nine consolidated ones, so their
    quantiles go to every task."""
    base = materialise(anomaly_base(changes, issues), "anomaly-base")
    p99 = group_quantile(base, "issuetype", "resolution_days", 0.99, "p99")
    return base.join(F.broadcast(p99), "issuetype").withColumn(
        "flag_outlier_resolution", S.flag(F.col("resolution_days") >= F.col("p99"))
    )


FLAGS = ["flag_high_churn", "flag_escalation_reversed", "flag_many_people", "flag_outlier_resolution"]


def anomaly_totals(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.sum(F.greatest(*FLAGS)).alias("n_any"), F.sum("flag_high_churn").alias("n_high_churn"),
        F.sum("flag_escalation_reversed").alias("n_escalation_reversed"),
        F.sum("flag_outlier_resolution").alias("n_outlier_resolution"),
        F.sum("flag_many_people").alias("n_many_people"),
    )


def monthly_anomalies(changes: DataFrame, issues: DataFrame) -> DataFrame:
    joined = changes.join(issues.select("key", "created_at"), "key")
    return joined.groupBy(S.month_of(F.col("created_at")).alias("month")).agg(
        F.sum(_churn()).alias("high_churn"), F.sum(_reversed()).alias("escalation_reversed"),
        F.sum(_crowd()).alias("many_people"),
    )


def monthly_anomalies_long(monthly: DataFrame) -> DataFrame:
    names = {"high_churn": "High churn", "escalation_reversed": "Escalation reversed", "many_people": "Many people"}
    long = monthly.unpivot("month", list(names), "anomaly", "n")
    label = None
    for old, new in names.items():
        label = (F if label is None else label).when(F.col("anomaly") == old, new)
    return long.withColumn("anomaly", label)


def anomaly_table(rows: DataFrame, flags: Sequence[str] = tuple(FLAGS)) -> DataFrame:
    """Rows with any of the chosen flags, labelled, slowest first."""
    return (
        rows.where(S.any_flag(flags))
        .select("key", "issuetype", "resolution", "priority", "year_created", "resolution_days",
                "n_status_changes", "n_assignee_changes", "n_people_involved",
                S.flag_names().alias("anomalies"), "summary_excerpt")
        .orderBy(F.desc("resolution_days"), "key")
    )
