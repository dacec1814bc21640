"""Staging and feature tables on hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from triagelake.operators import features, staging

EVENT = "key string, author string, created timestamp, field string, from_string string, to_string string"


def changes(spark, rows):
    raw = [(k, a, f"2020-01-{d:02d} 00:00:00", f, x, y) for k, a, d, f, x, y in rows]
    return spark.createDataFrame(raw, "key string, author string, created string, field string, from_string string, to_string string").withColumn(
        "created", F.to_timestamp("created"))


def priority(key, *values, start=1, first="Minor"):
    before = [first, *values]
    return [(key, "ann", start + i, "Priority", before[i], v) for i, v in enumerate(values)]


@pytest.mark.parametrize("values, initial, up, down", [
    ((), False, None, None),
    (("Major",), False, 0, 0),
    (("Major",), True, 1, 0),
    (("Minor", "Major"), False, 1, 0),
    (("Blocker", "Trivial", "Major"), False, 1, 1),
    (("Major", "odd", "Blocker"), False, 0, 0),  # an unknown rank breaks the chain
    (("major", "MINOR"), False, 0, 1),
])
def test_escalation(spark, values, initial, up, down):
    rows = changes(spark, priority("A", *values) + [("A", "bob", 20, "Status", "Open", "Closed")])
    got = features.change_features(rows, include_initial=initial).first()
    assert (got.was_escalated, got.was_deescalated) == (up or 0, down or 0)


def test_escalation_of_one_hot_key_over_many_slices(spark):
    """One key holds nearly all events; neighbours at slice borders must count."""
    ranks = ["Trivial"] * 400 + ["Minor"] * 400  # exactly one rise, anywhere in the order
    rows = [("HOT", "ann", i, "Priority", None, r) for i, r in enumerate(ranks)] + [("B", "ann", 1, "Priority", None, "Minor")]
    df = spark.createDataFrame(rows, "key string, author string, n int, field string, from_string string, to_string string")
    df = df.withColumn("created", F.timestamp_seconds(F.col("n") * 60)).drop("n").repartition(8)
    moves = {r.key: (r.was_escalated, r.was_deescalated) for r in features.priority_moves(df).collect()}
    assert moves == {"HOT": (1, 0), "B": (0, 0)}
    order = features.event_order(df).where("key = 'HOT'").orderBy("created").select("change_order").collect()
    assert [r[0] for r in order] == list(range(1, 801))


def test_counts_follow_the_counted_fields(spark):
    rows = changes(spark, [
        ("A", "ann", 1, "status", "o", "p"), ("A", "bob", 2, "Assignee", None, None), ("A", "bob", 3, "ASSIGNEE", None, "zoe"),
        ("A", "cat", 4, "assignee", "zoe", "yan"), ("A", "ann", 5, "issuetype", "x", "y"), ("A", "dan", 6, "Resolution", None, "Done"),
    ])
    got = features.change_features(rows).first()
    assert (got.n_total_changes, got.n_status_changes, got.n_assignee_changes, got.n_resolution_changes) == (5, 1, 3, 1)
    assert (got.n_people_involved, got.first_assignee) == (4, "zoe")


def test_link_row_with_both_directions_counts_twice(spark):
    links = spark.createDataFrame([("A", "Blocks", "X", "Y"), ("A", "blocks", "X", None), ("A", "is Clones of", None, "Z"), ("A", "Relates", None, "Q")],
                                  "key string, type_name string, inwardissue_key string, outwardissue_key string")
    got = features.link_features(links).first()
    assert (got.n_links_total, got.n_blocks, got.n_blocked_by, got.n_clones, got.n_relates) == (4, 2, 1, 1, 1)


def comments(spark, n, body="comment number {:03d}", key="A"):
    rows = [(key, f"{i:04d}", f"u{i % 3}", body.format(i), i) for i in range(n)]
    return spark.createDataFrame(rows, "key string, comment_id string, comment_author string, comment_body string, n int").withColumn(
        "comment_created", F.timestamp_seconds(F.col("n") * 60)).drop("n").repartition(6)


@pytest.mark.parametrize("n", [0, 5, 6, 9])
def test_snippets_take_first_five_and_last_three_once(spark, n):
    rows = features.comment_snippets(features.clean_comments(comments(spark, n))).collect()
    if n == 0:
        assert rows == []
        return
    picked = list(range(n)) if n <= 8 else [0, 1, 2, 3, 4, 6, 7, 8]
    assert rows[0].comment_snippets == " || ".join(f"comment number {i:03d}" for i in picked)


def test_rollup_equals_full_concatenation_on_a_hot_key(spark):
    """The per-task limit on rows must not change the cut text."""
    df = comments(spark, 1200, body="shortest{:02d}x")
    got = features.comment_features(df).first()
    want = " | ".join(f"shortest{i:02d}x" for i in range(1200))[:3000]
    assert got.all_comments == want and got.n_comments == 1200 and got.n_commenters == 3


def test_short_comments_are_dropped_after_cleaning(spark):
    df = comments(spark, 3, body="<b>{:d}</b> hi")
    assert features.clean_comments(df).count() == 0


def raw_issue(spark, rows):
    names = ("id key summary description created resolutiondate issuetype_name resolution_name resolution_description priority_name "
             "status_name project_key assignee reporter creator votes_votes watches_watchcount").split()
    full = [{**dict.fromkeys(names), "key": "K", "project_key": "P", "created": "2020-01-01 00:00:00", **r} for r in rows]
    return spark.createDataFrame([tuple(f[n] for n in names) for f in full], ", ".join(f"{n} string" for n in names))


def test_duplicate_keys_keep_the_smallest_id_as_text(spark):
    raw = raw_issue(spark, [{"id": "9", "summary": "nine"}, {"id": "10", "summary": "ten"}, {"id": "1", "key": "L", "project_key": "Q"}])
    got = staging.stage_issues(raw, "P").collect()
    assert [(r.issue_id, r.summary, r.assignee) for r in got] == [("10", "ten", "Unassigned")]


def test_label_consolidation_drops_unknown_resolutions(spark):
    raw = raw_issue(spark, [
        {"id": "1", "key": "A", "issuetype_name": "Technical task", "resolution_name": "Done", "summary": "<i>raw</i>"},
        {"id": "2", "key": "B", "issuetype_name": "Never seen", "resolution_name": "Won't Do"},
        {"id": "3", "key": "C", "issuetype_name": "Bug", "resolution_name": "Auto Closed"},
        {"id": "4", "key": "D", "issuetype_name": "Bug"},
    ])
    got = {r.key: (r.issuetype, r.resolution, r.split) for r in features.clean_issues(staging.stage_issues(raw, None)).collect()}
    assert got == {"A": ("Task", "Fixed", "train"), "B": ("Other", "Won't Fix", "train")}
    first = features.clean_issues(staging.stage_issues(raw, None)).where("key = 'A'").first()
    assert (first.summary, first.summary_length) == ("raw", 10)
