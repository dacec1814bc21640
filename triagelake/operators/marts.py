"""Feature tables -> wide mart and analytics marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.functions import scalars as S
from triagelake.functions import text as X


def ml_mart(issues: DataFrame, comments: DataFrame, changes: DataFrame, links: DataFrame) -> DataFrame:
    """One wide row per ticket inside the splits. All four inputs hold one row
    per key, so the joins keep the key partitioning and cannot skew."""
    c = comments.select("key", "all_comments", "n_comments", "n_commenters")
    joined = (
        issues.where(F.col("split").isin("train", "validation", "test"))
        .join(c, "key", "left")
        .join(changes, "key", "left")
        .join(links, "key", "left")
    )

    def zero(*names: str) -> list[Column]:
        return [F.coalesce(n, F.lit(0)).alias(n) for n in names]

    summary, description = F.col("summary"), F.col("description")
    priority, status = F.col("priority"), F.col("status")
    discussion = F.coalesce("all_comments", F.lit(""))
    return joined.select(
        "key", "created_at", "split", "issuetype", "resolution",
        summary.alias("summary_clean"),
        description.alias("description_clean"),
        discussion.alias("comments_concat"),
        X.text_noco(summary, priority, status, description).alias("text_noco"),
        X.text_rich(
            summary, priority, status, F.coalesce("n_comments", F.lit(0)), description, discussion
        ).alias("text_rich"),
        "priority", "status", "reporter", "assignee",
        *zero(
            "n_total_changes", "n_status_changes", "n_priority_changes", "n_assignee_changes",
            "n_resolution_changes", "was_escalated", "was_deescalated", "n_people_involved",
        ),
        "first_assignee",
        *zero("n_links_total", "n_duplicates", "n_blocks", "n_blocked_by", "n_relates"),
        *zero("n_comments", "n_commenters"),
        "resolution_days", "summary_length", "description_length",
    )


def ops_mart(issues: DataFrame, comments: DataFrame) -> DataFrame:
    """Month x issue type volumes, resolution times, shares and richness. The
    exact median keeps counts per distinct day number, so its state stays small
    even where one group holds most rows."""
    base = issues.join(comments.select("key", "n_comments"), "key", "left").select(
        S.month_of(F.col("created_at")).alias("month"),
        "issuetype", "resolution", "resolution_days", "summary_length", "description_length",
        F.coalesce("n_comments", F.lit(0)).alias("n_comments"),
        S.flag(F.col("resolved_at").isNotNull()).alias("is_resolved"),
    )
    days = F.when(F.col("is_resolved") == 1, F.col("resolution_days"))

    def share(label: str) -> Column:
        return S.pct(F.count(F.when(F.col("resolution") == label, 1)), F.count("*"))

    return base.groupBy("month", "issuetype").agg(
        F.count("*").alias("total_issues"),
        F.sum("is_resolved").alias("total_resolved"),
        F.median(days).alias("median_resolution_days"),
        F.avg(days).alias("avg_resolution_days"),
        share("Fixed").alias("pct_fixed"),
        share("Won't Fix").alias("pct_wontfix"),
        share("Duplicate").alias("pct_duplicate"),
        share("Cannot Reproduce").alias("pct_cannot_reproduce"),
        S.round_half_up(F.avg("summary_length"), 1).alias("avg_summary_length"),
        S.round_half_up(F.avg("description_length"), 1).alias("avg_description_length"),
        S.round_half_up(F.avg("n_comments"), 2).alias("avg_n_comments"),
    )


def most_frequent(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Most frequent value per key, smallest value on ties. Counted first, so a
    hot key is at most as many rows as it has distinct values."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    best = F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(name)
    return counts.groupBy(*keys).agg(best)


def workload_mart(issues: DataFrame) -> DataFrame:
    """Load per assignee, in two steps: (assignee, type) totals, then assignee."""
    mine = issues.where(F.col("assignee").isNotNull() & (F.col("assignee") != "Unassigned"))
    days = F.when(F.col("resolved_at").isNotNull(), F.col("resolution_days"))
    by_type = mine.groupBy("assignee", "issuetype").agg(
        F.count("*").alias("_n"),
        F.count(F.when(F.col("resolution") == "Fixed", 1)).alias("_fixed"),
        F.sum(days).alias("_days"),
        F.count(days).alias("_ended"),
    )
    return by_type.groupBy("assignee").agg(
        F.sum("_n").alias("n_assigned"),
        F.sum("_fixed").alias("n_fixed"),
        S.round_half_up(S.safe_ratio(F.sum("_days"), F.sum("_ended")), 1).alias("avg_resolution_days"),
        F.min_by("issuetype", F.struct(-F.col("_n"), F.col("issuetype"))).alias("top_issuetype"),
        F.count("issuetype").alias("n_distinct_issuetypes"),
    )


def links_mart(links: DataFrame) -> DataFrame:
    return links.where(F.col("n_links_total") > 0).select(
        "key", "n_links_total", "n_duplicates", "n_blocks", "n_blocked_by", "n_relates",
        (F.col("n_duplicates") + F.col("n_blocks") + F.col("n_blocked_by")).alias(
            "n_outgoing_plus_incoming"
        ),
    )
