"""Block plans against brute force; votes and gates."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from triagelake import constants as C
from triagelake.operators import grid, lexical, retrieval, voting

VECTORS = "key string, vec_a array<double>, vec_b array<double>, priority string"


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, prefix, n, seed, dims=6, ties=False):
    rng = np.random.default_rng(seed)
    draw = (lambda: rng.integers(-1, 2, (n, dims)).astype(float) + 1e-3) if ties else (lambda: rng.normal(size=(n, dims)))
    a, b = unit(draw()), unit(draw())
    rows = [(f"{prefix}{i}", a[i].tolist(), b[i].tolist(), None if i % 5 == 0 else f"p{i % 3}") for i in range(n)]
    return rows, spark.createDataFrame(rows, VECTORS)


def rounded(x):
    return np.sign(x) * np.floor(np.abs(x) * 1e9 + 0.5) / 1e9


def brute_rrf(queries, corpus, k, top):
    out = {}
    for q in queries:
        ranks = []
        for side in (1, 2):
            sims = {c[0]: float(rounded(np.dot(q[side], c[side]))) for c in corpus}
            order = sorted(sims, key=lambda x: (-sims[x], x))
            ranks.append({x: i + 1 for i, x in enumerate(order)})
        score = {c[0]: 1 / (k + ranks[0][c[0]]) + 1 / (k + ranks[1][c[0]]) for c in corpus}
        best = sorted(score, key=lambda x: (-score[x], x))[:top]
        out[q[0]] = [(x, ranks[0][x], ranks[1][x]) for x in best]
    return out


@pytest.fixture(autouse=True)
def small_batches(spark):
    """Several batches in every run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rows_that_leave_the_first_pass_do_not_grow_with_the_corpus(spark, monkeypatch):
    rng = np.random.default_rng(1)
    tables = [spark.createDataFrame([(f"k{i:04d}", rng.normal(size=4).tolist(), rng.normal(size=4).tolist()) for i in range(n)],
                                    "key string, vec_a array<double>, vec_b array<double>") for n in (20, 100, 400)]
    queries = tables[0]
    cells, real = [], grid.on_grid
    monkeypatch.setattr(grid, "on_grid", lambda *a, **more: cells.append(real(*a, **more)) or cells[-1])
    for corpus in tables[1:]:
        retrieval.list_heads(queries, corpus, 6, ("vec_a", "vec_b"), runs=3)
    made = [c.count() for c in cells]
    assert made == [20 * 2 * 3 * 6] * 2


def test_rows_moved_grow_with_the_tables_not_faster(spark):
    answers, moved = 2 * retrieval.head_size(60, 30), []
    for q, n in ((1249, 5128), (6417, 25586)):  # both about five times as many
        blocks, runs = spark.range(1).select(*grid._sizes(spark.range(q), spark.range(n), grid.QUERY_BLOCK_ROWS, None, answers=answers)).first()
        assert blocks * grid.QUERY_BLOCK_ROWS >= q and blocks * runs >= spark.sparkContext.defaultParallelism
        moved.append(n * blocks + q * runs * (1 + answers / grid.ANSWERS_A_ROW))
    assert moved[1] / moved[0] < 6417 / 1249
    assert tuple(spark.range(1).select(*grid._sizes(spark.range(0), spark.range(0), 5, None, answers=answers)).first()) == (1, 1)


def test_only_contenders_without_a_rank_meet_the_corpus(spark, monkeypatch):
    _, queries = frame(spark, "q", 5, 1)
    _, corpus = frame(spark, "c", 60, 2)
    seen, real = [], grid.on_grid
    monkeypatch.setattr(grid, "on_grid", lambda *a, **more: seen.append(a) or real(*a, **more))
    for same in (False, True):
        sides = [df.withColumn("vec_b", F.col("vec_a")) if same else df for df in (queries, corpus)]
        retrieval.rrf_top(*sides, k=5, top=4).count()
        asked = [c for r in seen[-1][0].collect() for c in r.contenders]
        assert set(seen[-1][0].schema["contenders"].dataType.elementType.names) == {"pos", "key", "in_a", "sim"}
        assert bool(asked) is not same


@pytest.mark.parametrize("seed, n, k, top, ties", [(1, 90, 5, 4, False), (2, 60, 2, 3, True), (3, 200, 60, 5, False), (4, 7, 60, 30, False)])
def test_rrf_equals_brute_force_over_many_blocks(spark, monkeypatch, seed, n, k, top, ties):
    queries, qdf = frame(spark, "q", 9, seed, ties=ties)
    corpus, cdf = frame(spark, "c", n, seed + 100, ties=ties)
    got = defaultdict(list)
    for r in retrieval.rrf_top(qdf, cdf, k, top, query_rows=4, runs=3).orderBy("query_key", "rk").collect():
        got[r.query_key].append((r.key, r.rank_a, r.rank_b))
    assert got == brute_rrf(queries, corpus, k, top)


def test_best_similarity_has_rank_one(spark):
    _, q = frame(spark, "q", 1, 5)
    axis = spark.createDataFrame([("q", [1.0, 0.0], [1.0, 0.0], None)], VECTORS)
    corpus = spark.createDataFrame([(f"c{i}", [math.cos(t), math.sin(t)], [math.cos(t), math.sin(t)], None) for i, t in enumerate((0.1, 1.4, 0.8))], VECTORS)
    got = [(r.key, r.rank_a) for r in retrieval.rrf_top(axis, corpus).orderBy("rk").collect()]
    assert got == [("c0", 1), ("c2", 2), ("c1", 3)]


@pytest.mark.parametrize("boosts", [{}, {"priority": 0.3}])
def test_top_k_over_blocks_equals_global_top_k(spark, monkeypatch, boosts):
    queries, qdf = frame(spark, "q", 11, 7, ties=True)
    corpus, cdf = frame(spark, "c", 130, 8, ties=True)
    got = defaultdict(list)
    for r in retrieval.top_k(qdf, cdf, "vec_a", 6, boosts, query_rows=3, runs=2).orderBy("query_key", "rk").collect():
        got[r.query_key].append(r.key)
    for q in queries:
        score = {}
        for c in corpus:
            same = boosts and q[3] is not None and q[3] == c[3]
            score[c[0]] = float(rounded(rounded(np.dot(q[1], c[1])) + (0.3 if same else 0.0)))
        assert got[q[0]] == sorted(score, key=lambda x: (-score[x], x))[:6]


def test_blocks_agree_with_the_expression(spark):
    _, qdf = frame(spark, "q", 3, 11)
    _, cdf = frame(spark, "c", 5, 12)
    blocks = {(r.query_key, r.key): r.sim for r in retrieval.top_k(qdf, cdf, "vec_a", 5).collect()}
    pairs = qdf.select(F.col("key").alias("query_key"), F.col("vec_a").alias("v")).join(cdf, F.lit(True))
    for r in pairs.select("query_key", "key", retrieval.cosine(F.col("v"), F.col("vec_a")).alias("sim")).collect():
        assert blocks[(r.query_key, r.key)] == pytest.approx(r.sim, abs=1e-9)


def test_best_columns_breaks_ties_by_column():
    rows, cols = grid.best_columns(np.array([[1.0, 2.0, 2.0, 2.0, 0.0], [0.0] * 5]), 2)
    assert list(zip(rows, cols)) == [(0, 1), (0, 2), (1, 0), (1, 1)]


def neighbours(spark, rows):
    return spark.createDataFrame([("q", "t", *r) for r in rows], "query_key string, target string, label string, weight double, rk int")


@pytest.mark.parametrize("rows, label, conf, margin", [
    ([("a", 0.5, 1), ("a", 0.4, 2)], "a", 1.0, 1.0),  # unanimous: nothing behind it
    ([("b", 0.5, 2), ("a", 0.5, 3), ("a", 0.2, 4), ("b", 0.2, 5)], "b", 0.5, 0.0),  # tie: best-ranked neighbour
    ([("a", 0.0, 1), ("b", 0.0, 2)], "a", 0.0, 0.0),
    ([("a", -0.5, 1), ("b", 0.2, 2)], "b", 0.0, 0.0),
    ([("a", 0.6, 1), ("b", 0.3, 2), ("c", 0.1, 3)], "a", 0.6, 0.3),
])
def test_vote(spark, rows, label, conf, margin):
    got = voting.vote(neighbours(spark, rows)).first()
    assert (got.label, got.conf, got.margin) == (label, pytest.approx(conf), pytest.approx(margin))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(-20, 99)), min_size=1, max_size=15), st.randoms())
def test_vote_does_not_depend_on_row_order(spark, rows, random):
    numbered = [(l, w / 100.0, i + 1) for i, (l, w) in enumerate(rows)]
    mixed = list(numbered)
    random.shuffle(mixed)
    assert voting.vote(neighbours(spark, numbered)).first() == voting.vote(neighbours(spark, mixed)).first()


def test_gates(spark):
    rows = [("issuetype", 0.55, 0.20, 4), ("issuetype", 0.55, 0.20, 5), ("resolution", 0.50, 0.15, 4), ("resolution", 0.49, 0.5, 1)]
    df = spark.createDataFrame([(t, c * 10, c * 10 * (1 - m) - 1e-9, 10.0, d) for t, c, m, d in rows], "target string, top1 double, top2 double, total double, div long")
    assert [r.method for r in voting.diversity_gate(df).collect()] == ["DIRECT", "LLM", "DIRECT", "LLM"]
    got = spark.createDataFrame([(0.65, 0.10), (0.65, 0.09), (0.64, 0.5)], "c double, m double").select(voting.margin_gate(F.col("c"), F.col("m"))).collect()
    assert [r[0] for r in got] == ["DIRECT", "LLM_REQUIRED", "LLM_REQUIRED"]


def test_nearest_label(spark):
    df = spark.createDataFrame([("Bug",), ("bug",), ("Imprvement",), ('"new feature" ',), ("zzzz",), (None,)], "a string")
    strict = [r[0] for r in df.select(voting.nearest_label(F.col("a"), C.ISSUE_TYPES)).collect()]
    loose = [r[0] for r in df.select(voting.nearest_label(F.col("a"), C.ISSUE_TYPES, True)).collect()]
    assert strict[:3] == ["Bug", "Bug", "Improvement"] and loose[3] == "New Feature" and strict[5] is None
    assert strict[4] == "Bug"  # four edits away like others, first in list order


def test_answers_only_replace_gated_votes(spark):
    votes = spark.createDataFrame([("q1", "issuetype", "Bug", "DIRECT"), ("q2", "issuetype", "Bug", "LLM"), ("q3", "issuetype", "Bug", "LLM")],
                                  "query_key string, target string, label string, method string")
    answers = spark.createDataFrame([("q1", "issuetype", "Task"), ("q2", "issuetype", "task")], "query_key string, target string, answer string")
    got = {r.query_key: r.final_label for r in voting.apply_answers(votes, answers).collect()}
    assert got == {"q1": "Bug", "q2": "Task", "q3": "Bug"}


def test_class_weights_are_balanced(spark):
    train = spark.createDataFrame([("Bug", "Fixed")] * 3 + [("Task", "Fixed")], "issuetype string, resolution string")
    got = {(r.target, r.label): r.multiplier for r in voting.class_weights(train).collect()}
    assert got == {("issuetype", "Bug"): pytest.approx(4 / 6), ("issuetype", "Task"): 2.0, ("resolution", "Fixed"): 1.0}


DOCS = ["the cat sat on the mat", "the dog", "cat cat cat the", "a bird sat", "", "the the the the"]
ASKS = ["the cat cat", "bird unknown", "zzz", ""]


def brute_bm25(docs, ask):
    words = [d.split() for d in docs]
    mean = sum(map(len, words)) / len(words)
    df = Counter(w for d in words for w in set(d))
    idf = {w: math.log(len(docs) - n + 0.5) - math.log(n + 0.5) for w, n in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: floor if v < 0 else v for w, v in idf.items()}
    return [sum(idf.get(w, 0) * d.count(w) * 2.5 / (d.count(w) + 1.5 * (0.25 + 0.75 * len(d) / mean)) for w in ask.split()) for d in words]


def test_bm25_equals_the_formula(spark, monkeypatch):
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(DOCS)], "key string, text string")
    asks = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(ASKS)], "key string, text string")
    got = defaultdict(list)
    for r in lexical.bm25_top_k(lexical.tokenised(asks, "text"), lexical.tokenised(docs, "text"), 4, query_rows=2, runs=2).orderBy("query_key", "rk").collect():
        got[r.query_key].append((r.key, pytest.approx(r.score, abs=1e-8)))
    for i, ask in enumerate(ASKS):
        scores = brute_bm25(DOCS, ask)
        best = sorted(range(len(DOCS)), key=lambda d: (-round(scores[d], 9), d))[:4]
        assert [(f"d{d}", scores[d]) for d in best] == got[f"q{i}"]
    pairs = spark.createDataFrame([("q0", f"d{d}") for d in range(len(DOCS))], "query_key string, key string")
    some = {r.key: r.bm25 for r in lexical.bm25_of_pairs(pairs, lexical.tokenised(asks, "text"), lexical.tokenised(docs, "text")).collect()}
    assert some == {f"d{d}": pytest.approx(v, abs=1e-8) for d, v in enumerate(brute_bm25(DOCS, ASKS[0]))}


def test_min_max_of_flat_range_is_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0), ("b", 4.0)], "query_key string, x double")
    assert sorted(r[0] for r in df.select(lexical.min_max("x")).collect()) == [0.0, 0.0, 0.0, 1.0]
