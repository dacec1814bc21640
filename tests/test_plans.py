"""The plans themselves, the stream, and queries against their SQL."""

from __future__ import annotations

import os

import pytest
from check_queries import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as entry
from triagelake.operators import retrieval
from triagelake.plans import catalog, registry
from triagelake.session import materialise
from triagelake.sources.bindings import Tracker
from triagelake.streaming import scoring

SMALL = "/root/testdata/sf0.001"
# quick ones by default; CHECK_ALL=1 runs every query
QUICK = ["a10_ops_monthly", "a17_box_by_type", "j4_consecutive_events", "m5_rrf_top30", "m16_predictions", "m17_bm25", "m25_arbitration",
         "m26_nearest_label", "p7_clean_text", "q2_unique", "s3_tolerant_load", "g1_streamed_scores",
         "a3_comment_rollup", "a4_comment_snippets", "a14_monthly_trend", "m1_text_neighbours", "m2_fingerprint", "m4_boosted_top15",
         "m25_gated_predictions", "m31_routing", "m32_anomalies", "p24_tokens", "p27_valid_input", "p31_guidance", "s4_header_contract",
         "s12_typed_insert", "w4_escalation", "o2_most_duplicated"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql_and_a_name_of_its_own():
    assert set(catalog.queries()) == set(catalog.oracle_sql()) and len(catalog.queries()) > 150
    assert set(catalog.queries()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(catalog.queries()) if os.environ.get("CHECK_ALL") else QUICK)
def test_query_equals_its_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SMALL), con, entry.oracle_sql()[name]) == ""


def test_relational_tables_stay_in_the_jvm(spark):
    t = Tracker(spark, SMALL)
    for df in (t.ml_mart(), t.ops_mart(), t.workload_mart(), t.links_mart(), t.change_features()):
        assert "Python" not in plan(df) and "Pandas" not in plan(df)


def test_no_pairs_are_joined_in_retrieval(spark):
    t = Tracker(spark, SMALL)
    text = plan(retrieval.retrieve(*registry.sides(t)))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_limits_reach_the_map_side(spark):
    t = Tracker(spark, SMALL)
    assert plan(t.first_lines()).count("WindowGroupLimit") == 2
    # the first comments of a key, and the first row of an issue key
    assert plan(t.comment_features()).count("WindowGroupLimit") == 4
    assert plan(retrieval.top_k(*registry.sides(t), "vec_a", 5)).count("WindowGroupLimit") == 2


def test_inputs_are_planned_once(spark):
    from triagelake.operators import dashboards, evaluation
    from triagelake.operators.enrichment import hashed_weights

    t = Tracker(spark, SMALL)
    assert plan(dashboards.anomalies(t.change_features(), t.cleaned())).count("Scan parquet") == 2  # one stored table, twice
    assert plan(evaluation.routing_share(t.cleaned(), ["issuetype"])).count("orders.parquet") == plan(t.cleaned()).count("orders.parquet")
    docs = t.table("documents").select(F.col("doc_id").alias("key"), "text")
    assert plan(hashed_weights(docs, "text")).count("ReadSchema: struct<doc_id:bigint,text:string>") == 0


def test_scans_are_pruned_and_filters_pushed(spark):
    t = Tracker(spark, SMALL)
    text = plan(t.ops_mart())
    assert "ReadSchema: struct<conv_id:bigint,text:string>" in text  # no role
    assert "o_totalprice" not in text and "s_name" not in text
    v = plan(registry.vectors(t).where("split = 'train'").select("key"))
    assert "EqualTo(split,train)" in v and "ReadSchema: struct<key:string,split:string>" in v


def test_lengths_do_not_drag_texts_through_the_exchange(spark):
    t = Tracker(spark, SMALL)
    issues = t.cleaned().select("key", "description_length")
    window = [line for line in plan(issues).splitlines() if "Window" in line or "Sort [key" in line]
    assert window and not any("description#" in line for line in window)


def test_stream_equals_batch_and_repeats_count_once(spark, tmp_path):
    t = Tracker(spark, SMALL)
    queries, corpus = registry.sides(t)
    queries.limit(12).repartition(3).write.parquet(str(tmp_path / "in"))
    arrived = spark.read.parquet(str(tmp_path / "in"))
    arrived.limit(4).write.mode("append").parquet(str(tmp_path / "in"))  # the same tickets again
    short = arrived.limit(1).withColumn("key", F.lit("SHORT")).withColumn("summary_clean", F.lit("tiny"))
    short.write.mode("append").parquet(str(tmp_path / "in"))
    run = scoring.score_new_tickets(spark, str(tmp_path / "in"), queries.schema, corpus, str(tmp_path / "out"), str(tmp_path / "state"), files_per_trigger=1)
    run.awaitTermination()
    scores = spark.read.parquet(str(tmp_path / "out" / "scores"))
    assert scores.select("batch_id").distinct().count() > 1
    stored = scores.drop("batch_id")
    distinct = spark.read.parquet(str(tmp_path / "in")).where("key <> 'SHORT'").dropDuplicates(["key"])
    batch = scoring.score_batch(distinct, corpus, retrieval.fitted_scaler(corpus))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, batch.collect()))
    # a second run finds nothing new
    scoring.score_new_tickets(spark, str(tmp_path / "in"), queries.schema, corpus, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "scores")).count() == stored.count()


def _above(plan: str, leaf: str) -> list[list[str]]:
    """For each line of a plan with ``leaf``: the operators above it, nearest first."""
    lines = [(len(line) - len(line.lstrip(" :+-|")), line.strip(" :+-|")) for line in plan.split("\n")]
    out = []
    for i, (depth, text) in enumerate(lines):
        if leaf in text:
            above = []
            for d, name in reversed(lines[:i]):
                if d < depth:
                    above.append(name)
                    depth = d
            out.append(above)
    return out


def test_a_micro_batch_does_not_move_the_index(spark):
    """The index is read where it lies: nothing between its scan and the scoring, or the
    join with the candidates, is an exchange; the result is that of the grid."""
    queries, corpus = registry.sides(Tracker(spark, SMALL))
    index, queries = materialise(corpus, "index-of-a-test"), materialise(queries, "tickets-of-a-test")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    scored = scoring.score_batch(queries, index)
    paths = _above(plan(scored), "index-of-a-test")
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert paths
    for above in paths:
        stop = next(i for i, name in enumerate(above) if "MapInArrow" in name or "BroadcastHashJoin" in name)
        assert not any("Exchange" in name for name in above[:stop]), above[:stop + 1]
    plain = retrieval.rerank(retrieval.rrf_top(queries, index), queries, index, scaled=False)
    due = scoring.voting.predictions(scoring.voting.vote(scoring.voting.by_target(retrieval.final_neighbours(plain))), queries)
    assert sorted(map(tuple, scored.collect()), key=str) == sorted(map(tuple, due.collect()), key=str)


def test_equal_scores_are_ordered_by_key_in_any_order_of_batches():
    import numpy as np

    from triagelake.operators.grid import Heads

    rng = np.random.default_rng(3)
    scores = rng.integers(0, 4, (5, 60)) / 4
    keys = np.array([f"k{i:02d}" for i in range(60)], object)
    due = [sorted(zip(-scores[q], keys))[:7] for q in range(5)]
    for seed in range(4):
        heads, order = Heads(5, 7), np.random.default_rng(seed).permutation(60)
        for some in np.array_split(order, 6):
            some = np.sort(some)
            heads.offer(slice(0, 5), scores[:, some], keys[some])
        assert [[(-s, k) for r, s, k in zip(heads.row, heads.score, heads.key) if r == q] for q in range(5)] == due
