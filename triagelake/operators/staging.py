"""Raw string tables -> typed staging tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagelake import constants as C
from triagelake.functions import scalars as S
from triagelake.functions import text as X
from triagelake.session import materialise


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key. ``order`` must end in a tie-break. The
    ``<= 1`` limit is applied per map task before the exchange, so a hot key
    sends one row per task, not all of its rows."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn <= 1").drop("_rn")


def only_known_keys(df: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """Rows whose key occurs in ``keys`` (unique there)."""
    return df.join(keys.select(key), key, "left_semi")


#: Keys that may come more than once where the rows of all others are left in place.
FEW_REPEATED = 100_000


def _of_project(raw: DataFrame, project: str | None) -> DataFrame:
    return raw if project is None else raw.where(F.col("project_key") == project)


def repeated_keys(raw: DataFrame, project: str | None) -> DataFrame | None:
    """The keys with more than one row (null is a key), counted without the other columns
    and stored (a job); None where they are more than a few."""
    keys = _of_project(raw, project).groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    stored = materialise(keys, "repeated-keys")
    return stored if stored.count() <= FEW_REPEATED else None


def stage_issues(
    raw: DataFrame, project: str | None, formats: Sequence[str] | None = None, repeated: DataFrame | None = None
) -> DataFrame:
    """Typed issues of one project (None: all), one row per key. ``id`` is text
    and sorts as text; creation time and summary break ties. The raw text lengths
    are taken ahead of the exchange: readers of lengths never move the texts. With
    ``repeated`` (``repeated_keys`` of the same rows) only rows of these keys are
    moved to be compared, and the texts of all others stay where they are read."""
    typed = _of_project(raw, project).select(
        F.col("id").alias("issue_id"),
        "key",
        "summary",
        "description",
        S.try_timestamp(F.col("created"), formats).alias("created_at"),
        S.try_timestamp(F.col("resolutiondate"), formats).alias("resolved_at"),
        F.col("issuetype_name").alias("issuetype_raw"),
        F.col("resolution_name").alias("resolution_raw"),
        F.col("priority_name").alias("priority"),
        F.col("status_name").alias("status"),
        F.col("project_key").alias("project"),
        S.blank_to(F.col("assignee"), "Unassigned").alias("assignee"),
        "reporter",
        "creator",
        S.try_long(F.col("votes_votes")).alias("votes"),
        S.try_long(F.col("watches_watchcount")).alias("watches"),
        X.text_length(F.col("summary")).alias("summary_length"),
        X.text_length(F.col("description")).alias("description_length"),
    )
    order = ["issue_id", "created_at", "summary"]
    if repeated is None:
        return keep_first(typed, ["key"], order)
    again = repeated.select(F.col("key").alias("_key"))
    same = F.col("key").eqNullSafe(F.col("_key"))
    return typed.join(again, same, "left_anti").unionByName(keep_first(typed.join(again, same, "left_semi"), ["key"], order))


def type_comments(raw: DataFrame, formats: Sequence[str] | None = None) -> DataFrame:
    return raw.select(
        "key", "comment_id", "comment_author", "comment_body",
        S.try_timestamp(F.col("comment_created"), formats).alias("comment_created"),
        S.try_timestamp(F.col("comment_updated"), formats).alias("comment_updated"),
    )


def type_changelog(raw: DataFrame, formats: Sequence[str] | None = None) -> DataFrame:
    return raw.where(S.in_ignoring_case(F.col("field"), C.STAGED_CHANGE_FIELDS)).select(
        "key", "author",
        S.try_timestamp(F.col("created"), formats).alias("created"),
        "field",
        F.col("fromstring").alias("from_string"),
        F.col("tostring").alias("to_string"),
    )


def type_links(raw: DataFrame) -> DataFrame:
    return raw.select("key", "type_name", "inwardissue_key", "outwardissue_key")


def stage_comments(raw: DataFrame, issues: DataFrame, formats: Sequence[str] | None = None) -> DataFrame:
    return only_known_keys(type_comments(raw, formats), issues)


def stage_changelog(raw: DataFrame, issues: DataFrame, formats: Sequence[str] | None = None) -> DataFrame:
    return only_known_keys(type_changelog(raw, formats), issues)


def stage_links(raw: DataFrame, issues: DataFrame) -> DataFrame:
    return only_known_keys(type_links(raw), issues)
