"""Checks, dashboards and enrichment on hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from triagelake.operators import dashboards, enrichment, marts, quality
from triagelake.session import shared_dir


def test_suite_declares_55_checks():
    assert len(quality.SUITE) == 55


def test_suite_counts_failures(spark):
    parent = spark.createDataFrame([("a",), ("b",)], "key string")
    child = spark.createDataFrame([("a", "x", 1), ("a", "y", -1), (None, None, None), ("z", "q", 5)], "key string, kind string, n int")
    suite = [("child", "key", "unique", None), ("child", "key", "not_null", None), ("child", "key", "relationship", "parent"),
             ("child", "kind", "accepted_values", ["x", "y"]), ("child", "n", "expression", ">= 0")]
    got = {(r.column_name, r.check_name): (r.failures, r.status) for r in quality.run_suite({"child": child, "parent": parent}, suite).collect()}
    assert got == {("key", "unique"): (1, "FAIL"), ("key", "not_null"): (1, "FAIL"), ("key", "relationship"): (1, "FAIL"),
                   ("kind", "accepted_values"): (1, "FAIL"), ("n", "expression"): (1, "FAIL")}


def test_count_checks(spark):
    tables = {"a": spark.range(100), "b": spark.range(5)}
    assert [r.status for r in quality.row_counts(tables, {"a": 100, "b": 6}).orderBy("table_name").collect()] == ["OK", "BELOW THRESHOLD"]
    assert [r.status for r in quality.count_near(tables, {"a": 101, "b": 6}).orderBy("table_name").collect()] == ["OK", "VERIFY"]
    assert quality.count_in_range(spark.range(5), 1, 4).first().status == "CHECK DATA"


def test_mode_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", None), ("k", None), ("k", None), ("l", "c")], "key string, v string")
    assert {r.key: r.m for r in marts.most_frequent(df, ["key"], "v", "m").collect()} == {"k": "a", "l": "c"}


def test_workload_leaves_out_unassigned(spark):
    rows = [("ann", "Bug", "Fixed", 4, "2020-01-01"), ("ann", "Task", "Duplicate", 9, None), ("ann", "Bug", "Fixed", 5, "2020-01-01"), ("Unassigned", "Bug", "Fixed", 1, None)]
    df = spark.createDataFrame(rows, "assignee string, issuetype string, resolution string, resolution_days int, resolved_at string")
    got = [tuple(r) for r in marts.workload_mart(df).collect()]
    assert got == [("ann", 3, 2, 4.5, "Bug", 2)]


def test_box_stats_and_histogram(spark):
    days = [1, 2, 3, 4, 100]
    df = spark.createDataFrame([("g", d) for d in days], "g string, days int")
    r = dashboards.box_stats(df, "g").first()
    assert (r.n, r.low, r.q1, r.median, r.q3, r.high, r.whisker_low, r.whisker_high) == (5, 1.0, 2.0, 3.0, 4.0, 100.0, 1, 4)
    assert sorted((b.bin, b.n) for b in dashboards.histogram(df, bins=3).collect()) == [(0, 4), (2, 1)]
    flat = spark.createDataFrame([(7,), (7,)], "days int")
    assert [(b.bin, b.n, b.low_edge) for b in dashboards.histogram(flat).collect()] == [(0, 2, 7.0)]


def test_anomaly_flags(spark):
    changes = spark.createDataFrame([("a", 6, 0, 0, 1, 1, 1), ("b", 0, 4, 0, 6, 0, 1), ("c", 0, 0, 0, 1, 0, 0)],
                                    "key string, n_status_changes int, n_assignee_changes int, n_priority_changes int, n_people_involved int, was_escalated int, was_deescalated int")
    issues = spark.createDataFrame([(k, "Bug", "Fixed", "Major", d, "s") for k, d in (("a", 1), ("b", 2), ("c", 300))],
                                   "key string, issuetype string, resolution string, priority string, resolution_days int, summary string").withColumn("created_at", F.to_timestamp(F.lit("2020-05-05")))
    rows = dashboards.anomalies(changes, issues)
    got = {r.key: tuple(r[f] for f in dashboards.FLAGS) for r in rows.collect()}
    assert got == {"a": (1, 1, 0, 0), "b": (1, 0, 1, 0), "c": (0, 0, 0, 1)}
    assert tuple(dashboards.anomaly_totals(rows).first()) == (3, 2, 1, 1, 1)
    assert [r.key for r in dashboards.anomaly_table(rows, ["flag_many_people"]).collect()] == ["b"]


def test_stale_rows_and_fingerprint(spark):
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "key string, t string")
    new = spark.createDataFrame([("b", "Y"), ("a", "x"), ("c", "z")], "key string, t string")
    cache = enrichment.text_hashes(old, "t").withColumn("model", F.lit("m"))
    assert sorted(r.key for r in enrichment.stale_rows(enrichment.text_hashes(new, "t"), cache, "m").collect()) == ["b", "c"]
    assert enrichment.stale_rows(enrichment.text_hashes(old, "t"), cache, "other").count() == 2
    prints = [enrichment.corpus_fingerprint(enrichment.text_hashes(d, "t"), "m").first() for d in (old, old.orderBy(F.desc("key")), new)]
    assert prints[0] == prints[1] != prints[2]


def test_encoder_is_made_once_per_task_and_output_is_unit_length(spark):
    def make():
        import numpy as np

        return lambda texts: np.array([[len(t), 0.0] for t in texts])

    df = spark.createDataFrame([("a", "xyz"), ("b", ""), ("c", None)], "key string, t string")
    got = {r.key: r.vector for r in enrichment.embed(df, "t", make).collect()}
    assert got == {"a": [1.0, 0.0], "b": [0.0, 0.0], "c": [0.0, 0.0]}
    assert {r.key: r.vector for r in enrichment.embed(df, "t", make, prefix="p").collect()}["b"] == [1.0, 0.0]


def test_hashed_vectors_are_unit_or_zero(spark):
    df = spark.createDataFrame([("a", "red red blue"), ("b", "blue green"), ("c", "")], "key string, t string")
    got = {r.key: r.vector for r in enrichment.hashed_vectors(df, "t", 32).collect()}
    assert all(len(v) == 32 for v in got.values()) and sum(x * x for x in got["c"]) == 0
    assert abs(sum(x * x for x in got["a"]) - 1) < 1e-9


def test_cache_keeps_old_summaries_and_skips_unanswered(spark):
    cache = spark.createDataFrame([("a", "old")], "key string, fix_summary string")
    prompts = spark.createDataFrame([("b", "p" * 300), ("c", "")], "key string, prompt string")

    def make():
        return lambda texts: [t or None for t in texts]

    got = {r.key: r.fix_summary for r in enrichment.merged_cache(cache, prompts, make).collect()}
    assert got == {"a": "old", "b": "p" * 250}


def test_short_tickets_are_not_valid(spark):
    df = spark.createDataFrame([("long enough", "d" * 20), ("  short   ", "d" * 20), ("long enough", "d" * 19), (None, None)], "s string, d string")
    assert [r[0] for r in df.select(enrichment.valid_input(F.col("s"), F.col("d"))).collect()] == [True, False, False, False]


class Session:
    """Just what ``shared_dir`` reads of a session."""

    def __init__(self, folder, master="local[2]"):
        self.conf = {"spark.checkpoint.dir": folder}
        self.sparkContext = type("Context", (), {"applicationId": f"app-{folder}", "master": master})


def test_configured_shared_folder_is_used_and_else_one_own_folder():
    assert shared_dir(Session("/shared/somewhere/")) == "/shared/somewhere"
    unset = Session(None)
    assert shared_dir(unset) == shared_dir(unset) != shared_dir(Session(""))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError):
        shared_dir(Session(None, master))
    assert shared_dir(Session("hdfs:///x", master)) == "hdfs:///x"


def test_a_job_leaves_no_scratch_folder(spark):
    import os

    from triagelake.session import job_scratch, materialise

    with job_scratch(spark):
        path = materialise(spark.range(3), "x").inputFiles()[0].removeprefix("file://")
        folder = os.path.dirname(os.path.dirname(path))
        assert os.path.exists(path) and "job-" in folder
    assert not os.path.exists(folder)
