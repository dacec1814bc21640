"""Cases that the given tables don't reach, made by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from triagelake.functions import text as X
from triagelake.operators import enrichment, features, retrieval, voting
from triagelake.plans import jobs


def test_rollup_of_very_short_comments_fills_the_cut(spark):
    rows = [("K", f"{i:04d}", "u", "ab", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "key string, comment_id string, comment_author string, comment_body string, n int").withColumn(
        "comment_created", F.timestamp_seconds("n"))
    got = features.comment_features(df, min_chars=2).first()
    assert len(got.all_comments) == 3000 and got.all_comments == " | ".join(["ab"] * 1000)[:3000] and got.n_comments == 1000


@pytest.mark.parametrize("n, due", [(3, 3), (6, 6), (8, 8), (12, 8)])
def test_snippets_keep_comments_with_equal_values(spark, n, due):
    df = spark.createDataFrame([("K", None, "same words", None)] * n, "key string, comment_id string, body string, comment_created timestamp")
    assert features.comment_snippets(df).first().comment_snippets.count("same words") == due


def test_missing_change_feature_counts_as_zero(spark):
    names = retrieval.C.CHANGE_FEATURES
    row = {"a": 1} | {n: None for n in names} | {f"q_{n}": 0 for n in names}
    df = spark.createDataFrame([row], ", ".join(f"{k} int" for k in row))
    assert df.select(retrieval.change_similarity()).first()[0] == 1.0
    train = spark.createDataFrame([tuple([None] * len(names)), tuple([2] * len(names))], ", ".join(f"{n} int" for n in names))
    scaler = train.select(retrieval.fit_scaler(train)).first()[0]
    assert scaler[f"mean_{names[0]}"] == 1.0 and scaler[f"std_{names[0]}"] == 1.0


def test_fingerprint_sees_swapped_texts(spark):
    def of(rows):
        return enrichment.corpus_fingerprint(enrichment.text_hashes(spark.createDataFrame(rows, "key string, text string"), "text"), "m").first().corpus_hash

    assert of([("a", "x"), ("b", "y")]) == of([("b", "y"), ("a", "x")]) != of([("a", "y"), ("b", "x")])
    assert of([("a", None)]) != of([("b", None)])


def test_blanks_of_any_alphabet(spark):
    text = "One two　three \x1c four\t\n five\u0085"
    df = spark.createDataFrame([(text, "\n" * 12, "\t " * 25), (None, "ten chars!", "a" * 20)], "t string, s string, d string")
    got = df.select(X.tokens(F.col("t")), enrichment.valid_input(F.col("s"), F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(["one", "two", "three", "four", "five"], False), ([], True)]


def test_query_without_neighbours_is_a_row_without_labels(spark):
    votes = spark.createDataFrame([("q1", "issuetype", "Bug", 0.9, 0.5), ("q1", "resolution", "Fixed", 0.9, 0.5)],
                                  "query_key string, target string, label string, conf double, margin double")
    queries = spark.createDataFrame([("q1", "Bug", "Fixed"), ("q2", "Task", "Invalid")], "key string, issuetype string, resolution string")
    got = {r.key: r for r in voting.predictions(votes, queries).collect()}
    assert got["q1"].pred_issuetype == "Bug" and got["q2"].pred_issuetype is None and got["q2"].true_issuetype == "Task"


def test_load_stops_at_a_moved_column(spark, tmp_path):
    (tmp_path / "c.csv").write_text("key,comment.author,comment.id,comment.body,comment.created,comment.updated\nK,a,1,x,2020-01-01,\n")
    with pytest.raises(ValueError, match="comment.id"):
        jobs.load_raw(spark, {"comments": str(tmp_path / "c.csv")}, str(tmp_path / "lake"))
    assert not (tmp_path / "lake").exists()


def test_repeated_insert_of_a_run_replaces_it(spark, tmp_path):
    from triagelake.sources import tables

    for _ in range(2):
        for run in ("a", "b"):
            got = tables.insert_into(spark.createDataFrame([(run,)], "k string"), str(tmp_path), "triage", "t", {"k": "string"}, run=run)
    assert got.columns == ["k"] and sorted(r.k for r in got.collect()) == ["a", "b"]


def test_fixed_values():
    from triagelake import constants as C

    assert (C.RRF_K, C.RRF_TOP, C.FINAL_K, C.BM25_K1, C.BM25_B) == (60, 30, 15, 1.5, 0.75)
    assert C.METADATA_WEIGHTS == {"priority": 0.10, "status": 0.08, "reporter": 0.05} and C.MARGIN_GATE == (0.65, 0.10)
