"""Staging tables -> cleaned issues and per-key features.

Every feature table is aggregated before it meets the issues: the partial
aggregates shrink a hot key inside the map tasks, and the joins that follow see
one row per key on both sides.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagelake import constants as C
from triagelake.functions import scalars as S
from triagelake.functions import text as X
from triagelake.operators.staging import only_known_keys
from triagelake.session import materialise

# --- labels --------------------------------------------------------------------


def seed_frame(df: DataFrame, rows: Sequence[tuple[str, str]], names: tuple[str, str]) -> DataFrame:
    return df.sparkSession.createDataFrame(list(rows), f"{names[0]} string, {names[1]} string")


def consolidate_labels(
    issues: DataFrame,
    type_seed: DataFrame | None = None,
    resolution_seed: DataFrame | None = None,
) -> DataFrame:
    """Add issuetype (unknown -> Other) and resolution (unknown -> NULL). The own
    seeds are fixed lists of 22 and 15 rows, which bounds their broadcast; a
    caller's seed is left to the optimizer's size check."""
    types, resolutions = type_seed, resolution_seed
    if types is None:
        types = F.broadcast(seed_frame(issues, C.ISSUE_TYPE_SEED, ("issuetype_raw", "issuetype")))
    if resolutions is None:
        resolutions = F.broadcast(seed_frame(issues, C.RESOLUTION_SEED, ("resolution_raw", "resolution")))
    return (
        issues.join(types, "issuetype_raw", "left")
        .join(resolutions, "resolution_raw", "left")
        .withColumn("issuetype", F.coalesce("issuetype", F.lit("Other")))
    )


def clean_issues(issues: DataFrame, split_bounds: Sequence[str] = C.SPLIT_BOUNDS) -> DataFrame:
    """Cleaned texts, consolidated labels, days, raw lengths and split; rows
    without a known resolution are dropped."""
    return (
        consolidate_labels(issues)
        .where(F.col("resolution").isNotNull())
        .select(
            "key", "issue_id", "created_at", "resolved_at", "priority", "status", "project",
            "assignee", "reporter", "creator", "votes", "watches", "issuetype_raw",
            "resolution_raw", "issuetype", "resolution",
            X.clean_ticket_text(F.col("summary")).alias("summary"),
            X.clean_ticket_text(F.col("description")).alias("description"),
            S.capped_days(F.col("created_at"), F.col("resolved_at")).alias("resolution_days"),
            "summary_length", "description_length",
            S.temporal_split(F.col("created_at"), split_bounds).alias("split"),
        )
    )


# --- comments --------------------------------------------------------------------


MIN_COMMENT_CHARS = 10


def clean_comments(comments: DataFrame, min_chars: int = MIN_COMMENT_CHARS) -> DataFrame:
    body = X.clean_ticket_text(F.col("comment_body"))
    return comments.withColumn("body", body).where(X.long_enough(F.col("body"), min_chars))


def joined_text(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], sep: str, cut: int,
    min_chars: int, name: str,
) -> DataFrame:
    """Values of a key in ``order``, joined by ``sep`` and cut to ``cut``.

    Every value has at least ``min_chars`` characters, so the first
    ceil(cut / (min_chars + len(sep))) + 1 values already fill the cut. That
    exact limit reaches the map tasks ahead of the exchange, and no more than
    ``cut`` characters of a value can show: a key of any size arrives as a
    small bounded group."""
    enough = math.ceil(cut / (min_chars + len(sep))) + 1
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    heads = (
        df.select(*keys, *order, F.substring(value, 1, cut).alias("_v"))
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= enough)
    )
    parts = F.transform(F.sort_array(F.collect_list(F.struct("_rn", "_v"))), lambda s: s["_v"])
    return heads.groupBy(*keys).agg(F.substring(F.array_join(parts, sep), 1, cut).alias(name))


def comment_rollup(cleaned: DataFrame, cut: int = 3000, min_chars: int = MIN_COMMENT_CHARS) -> DataFrame:
    """All comments of a key in time order, ' | ' between, cut; comment_id breaks ties.
    ``min_chars`` is the least length that ``cleaned`` was filtered by."""
    return joined_text(
        cleaned, ["key"], "body", ["comment_created", "comment_id"], " | ", cut, min_chars, "all_comments"
    )


def comment_snippets(
    cleaned: DataFrame, first: int = 5, last: int = 3, chars: int = 400, sep: str = " || "
) -> DataFrame:
    """First comments plus, where a key has more, the last ones; each cut.
    Both windows are limited per map task. Comments are told apart by their place, not
    by their values: a last one counts if it lies behind the first ones."""
    rows = cleaned.select("key", "comment_created", "comment_id", F.substring("body", 1, chars).alias("_v"))
    names = ("comment_created", "comment_id", "_v")
    w = Window.partitionBy("key")
    asc, desc = ([getattr(F.col(c), how)() for c in names] for how in ("asc_nulls_last", "desc_nulls_first"))
    head = rows.withColumn("_rn", F.row_number().over(w.orderBy(*asc))).where(F.col("_rn") <= first)
    tail = rows.withColumn("_back", F.row_number().over(w.orderBy(*desc))).where(F.col("_back") <= last)
    sizes = rows.groupBy("key").agg(F.count("*").alias("_n"))
    behind = tail.join(sizes, "key").where(F.col("_back") <= F.col("_n") - first).withColumn("_rn", (F.col("_n") - F.col("_back") + 1).cast("int"))
    both = head.select("key", "_rn", "_v").unionByName(behind.select("key", "_rn", "_v"))
    parts = F.sort_array(F.collect_list(F.struct("_rn", "_v")))
    return both.groupBy("key").agg(
        F.array_join(F.transform(parts, lambda s: s["_v"]), sep).alias("comment_snippets")
    )


def comment_stats(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("key").agg(
        F.count("*").alias("n_comments"),
        F.countDistinct("comment_author").alias("n_commenters"),
        F.min("comment_created").alias("first_comment_at"),
        F.max("comment_created").alias("last_comment_at"),
    )


def comment_features(
    comments: DataFrame, issues: DataFrame | None = None, min_chars: int = MIN_COMMENT_CHARS
) -> DataFrame:
    """Rollup and counts per key. Without ``issues`` no key is dropped: enough
    where the result is left-joined to the issues anyway. The cleaned rows are
    stored (a job), because both readers need them and cleaning is the costly part."""
    cleaned = materialise(
        clean_comments(comments, min_chars).select("key", "comment_id", "comment_author", "comment_created", "body"), "comments"
    )
    out = comment_rollup(cleaned, min_chars=min_chars).join(comment_stats(cleaned), "key")
    return out if issues is None else only_known_keys(out, issues)


# --- change history --------------------------------------------------------------

EVENT_ORDER = ("created", "author", "to_string", "from_string")


def _nulls_last(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def _ordering(columns: Sequence[str]) -> Column:
    """Struct that sorts like ``_nulls_last``."""
    return F.struct(*[f for c in columns for f in (F.col(c).isNull(), F.col(c))])


def priority_moves(changes: DataFrame, include_initial: bool = False) -> DataFrame:
    """was_escalated / was_deescalated per key from consecutive priority events.

    A key's history may be far larger than a task should sort. The events are
    therefore range-split by (key, time): inside a slice neighbours are compared
    with ``lead``; each slice is then one row holding its first and last rank,
    and a second, tiny window compares the borders between slices. An unknown
    rank never counts. ``include_initial`` also compares the first event's old
    value with its new one."""
    rank = S.category_rank(F.col("to_string"))
    before = S.category_rank(F.col("from_string"))
    events = changes.where(F.upper("field") == "PRIORITY").select(
        "key", *EVENT_ORDER, rank.alias("_rank"), before.alias("_before")
    )
    sliced = events.repartitionByRange(F.col("key"), *_nulls_last(EVENT_ORDER)).withColumn(
        "_slice", F.spark_partition_id()
    )
    inside = Window.partitionBy("_slice", "key").orderBy(*_nulls_last(EVENT_ORDER))
    at = _ordering(EVENT_ORDER)
    slices = (
        sliced.withColumn("_next", F.lead("_rank").over(inside))
        .groupBy("_slice", "key")
        .agg(
            F.max(S.flag(F.col("_next") > F.col("_rank"))).alias("_up"),
            F.max(S.flag(F.col("_next") < F.col("_rank"))).alias("_down"),
            F.min_by("_rank", at).alias("_first"),
            F.max_by("_rank", at).alias("_last"),
            F.min_by("_before", at).alias("_initial"),
        )
    )
    across = Window.partitionBy("key").orderBy("_slice")
    after = F.lead("_first").over(across)
    up = F.greatest("_up", S.flag(after > F.col("_last")))
    down = F.greatest("_down", S.flag(after < F.col("_last")))
    if include_initial:
        opening = F.lag(F.lit(1)).over(across).isNull()
        up = F.greatest(up, S.flag(opening & (F.col("_first") > F.col("_initial"))))
        down = F.greatest(down, S.flag(opening & (F.col("_first") < F.col("_initial"))))
    return (
        slices.withColumn("_u", up)
        .withColumn("_d", down)
        .groupBy("key")
        .agg(F.max("_u").alias("was_escalated"), F.max("_d").alias("was_deescalated"))
    )


def change_counts(changes: DataFrame) -> DataFrame:
    """Counts per kind, distinct people, and the first assignee set."""
    def kind(name: str) -> Column:
        return F.count(F.when(F.upper("field") == name, 1))

    assigned = (F.upper("field") == "ASSIGNEE") & F.col("to_string").isNotNull()
    return (
        changes.where(S.in_ignoring_case(F.col("field"), C.COUNTED_CHANGE_FIELDS))
        .groupBy("key")
        .agg(
            F.count("*").alias("n_total_changes"),
            kind("STATUS").alias("n_status_changes"),
            kind("PRIORITY").alias("n_priority_changes"),
            kind("ASSIGNEE").alias("n_assignee_changes"),
            kind("RESOLUTION").alias("n_resolution_changes"),
            F.countDistinct("author").alias("n_people_involved"),
            F.min_by(
                F.when(assigned, F.col("to_string")), F.when(assigned, _ordering(EVENT_ORDER))
            ).alias("first_assignee"),
        )
    )


def event_order(changes: DataFrame, field: str = "PRIORITY") -> DataFrame:
    """Global position of each event of one kind inside its key, hot keys
    included: positions are counted inside range slices and shifted by the sizes
    of the earlier slices."""
    events = changes.where(F.upper("field") == field).select("key", *EVENT_ORDER)
    sliced = events.repartitionByRange(F.col("key"), *_nulls_last(EVENT_ORDER)).withColumn(
        "_slice", F.spark_partition_id()
    )
    inside = Window.partitionBy("_slice", "key").orderBy(*_nulls_last(EVENT_ORDER))
    # stored, because both readers below must see the same slices
    placed = materialise(
        sliced.withColumn("_rn", F.row_number().over(inside)).withColumn(
            "_end", F.lead(F.lit(1)).over(inside).isNull()
        ),
        "event-slices",
    )
    # the last row of a slice carries its size: one row per (key, slice)
    sizes = placed.where("_end").select("key", "_slice", F.col("_rn").alias("_n"))
    before = Window.partitionBy("key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "key", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    return placed.join(shifts, ["key", "_slice"]).select(
        "key", *EVENT_ORDER, (F.col("_rn") + F.col("_shift")).alias("change_order")
    )


def change_features(
    changes: DataFrame, issues: DataFrame | None = None, include_initial: bool = False
) -> DataFrame:
    out = (
        change_counts(changes)
        .join(priority_moves(changes, include_initial), "key", "left")
        .select(
            "key", "n_total_changes", "n_status_changes", "n_priority_changes",
            "n_assignee_changes", "n_resolution_changes", "n_people_involved",
            F.coalesce("was_escalated", F.lit(0)).alias("was_escalated"),
            F.coalesce("was_deescalated", F.lit(0)).alias("was_deescalated"),
            "first_assignee",
        )
    )
    return out if issues is None else only_known_keys(out, issues)


# --- links ---------------------------------------------------------------------


def link_features(links: DataFrame, issues: DataFrame | None = None) -> DataFrame:
    """Degree counts per key. A BLOCKS row with an inward key counts as blocks,
    with an outward key as blocked by, with both as both."""
    kind = F.upper("type_name")

    def n(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    out = links.groupBy("key").agg(
        F.count("*").alias("n_links_total"),
        n(kind == "DUPLICATE").alias("n_duplicates"),
        n((kind == "BLOCKS") & F.col("inwardissue_key").isNotNull()).alias("n_blocks"),
        n((kind == "BLOCKS") & F.col("outwardissue_key").isNotNull()).alias("n_blocked_by"),
        n(kind == "RELATES").alias("n_relates"),
        n(kind.like("%CLONES%")).alias("n_clones"),
    )
    return out if issues is None else only_known_keys(out, issues)
