"""BM25: one pass over the texts, and bounds that leave out nothing."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from triagelake import constants as C
from triagelake.operators import lexical

WORDS = pa.list_(pa.struct([("id", pa.int64()), ("tf", pa.int32())]))


def zipf(rng, n, size, most):
    return [np.minimum(rng.zipf(1.3, rng.integers(0, most)), size) for _ in range(n)]


def plain(queries, docs, norm, k, keys):
    out = []
    for terms, weights in queries:
        scores = np.zeros(len(docs))
        for t, w in zip(terms, weights):
            tf = np.array([np.count_nonzero(d == t) for d in docs])
            scores += np.where(tf > 0, w * tf * (C.BM25_K1 + 1) / (tf + norm), 0.0)
        scores = np.sign(scores) * np.floor(np.abs(scores) * 1e9 + 0.5) / 1e9 + 0.0
        out.append(sorted(zip(-scores, keys))[:k])
    return out


@pytest.mark.parametrize("seed", range(4))
def test_pruned_scores_equal_plain_ones_and_skip_most_postings(monkeypatch, seed):
    if seed == 3:
        monkeypatch.setattr(lexical, "_AT_ONCE", 50)
        monkeypatch.setattr(lexical.grid, "SCORE_CELLS", 500)
    rng = np.random.default_rng(seed)
    size, n = 400, 600
    docs = zipf(rng, n, size, 60)
    df = np.array([sum(t in d for d in docs) for t in range(size + 1)])
    idf = np.log((n - df + 0.5) / (df + 0.5))
    idf = np.where(idf < 0, -0.1 if seed == 2 else 0.02, idf)
    asked = [np.unique(q) for q in zipf(rng, 25, size, 12)] + [np.array([], np.int64), np.array([10**9])]
    queries = [(q, np.array([idf[t] if t <= size else 1.0 for t in q])) for q in asked]
    norm = C.BM25_K1 * (1 - C.BM25_B + C.BM25_B * np.array([len(d) for d in docs]) / 20)
    keys = np.array([f"d{i:04d}" for i in rng.permutation(n)], object)
    order = np.argsort(keys)
    scorer = lexical.Scorer(pa.chunked_array([pa.array([q.tolist() for q, _ in queries], pa.list_(pa.int64()))]),
                            pa.chunked_array([pa.array([w.tolist() for _, w in queries], pa.list_(pa.float64()))]), 5)
    full = 0
    for some in np.array_split(order, 12):
        rows = [[{"id": int(t), "tf": int(c)} for t, c in zip(*np.unique(docs[i], return_counts=True))] for i in some]
        scorer.add(pa.chunked_array([pa.array(rows, WORDS)]), norm[some], keys[some])
        full += sum(np.isin(q, docs[i]).sum() for q, _ in queries for i in some)
    due = plain(queries, docs, norm, 5, keys)
    h = scorer.heads
    got = [[(-s, k) for r, s, k in zip(h.row, h.score, h.key) if r == q] for q in range(len(queries))]
    assert got == due
    if seed < 2:
        assert scorer.scored < full / 2


def test_texts_are_tokenised_once(spark, monkeypatch):
    """Of the jobs and the plan of a search only the one that stores the counts splits corpus texts."""
    docs = spark.createDataFrame([(f"d{i}", f"alpha beta{i % 3} gamma{i}") for i in range(20)], "key string, text string")
    asks = spark.createDataFrame([("q", "alpha beta1 alpha")], "key string, text string")
    plans, plain_store = {}, lexical.materialise
    monkeypatch.setattr(lexical, "materialise", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString()) and plain_store(df, name))
    best = lexical.bm25_top_k(lexical.tokenised(asks, "text"), lexical.tokenised(docs, "text"), 3)
    plans["search"] = best._jdf.queryExecution().optimizedPlan().toString()
    assert {name: plan.count("split(") for name, plan in plans.items() if "split(" in plan} == {"term-counts": 1, "query-terms": 1}
    assert [r.key for r in best.orderBy("rk").collect()] == ["d1", "d10", "d13"]


def test_words_that_queries_and_texts_share_are_not_added_one_by_one():
    """Common words reach almost every pair: bounds leave out little of them, a product sums them up."""
    rng = np.random.default_rng(7)
    docs = [np.concatenate([rng.choice(30, 20, replace=False), rng.integers(30, 3000, 3)]) for _ in range(400)]
    asked = [np.unique(d) for d in docs[:80]]
    weights = [np.where(q < 30, 1.0 + q / 50, 4.0) for q in asked]
    keys, norm = np.array([f"d{i:04d}" for i in range(400)], object), np.full(400, C.BM25_K1)
    scorer = lexical.Scorer(pa.chunked_array([pa.array([q.tolist() for q in asked], pa.list_(pa.int64()))]),
                            pa.chunked_array([pa.array([w.tolist() for w in weights], pa.list_(pa.float64()))]), 5)
    full = 0
    for some in np.array_split(np.arange(400), 4):
        rows = [[{"id": int(t), "tf": int(c)} for t, c in zip(*np.unique(docs[i], return_counts=True))] for i in some]
        scorer.add(pa.chunked_array([pa.array(rows, WORDS)]), norm[some], keys[some])
        full += sum(np.isin(q, docs[i]).sum() for q in asked for i in some)
    h = scorer.heads
    assert [[(-s, k) for r, s, k in zip(h.row, h.score, h.key) if r == q] for q in range(80)] == plain(list(zip(asked, weights)), docs, norm, 5, keys)
    assert scorer.scored < full / 20


def test_words_of_pairs_move_as_one_row_a_pair(spark, monkeypatch):
    """No exchange deals out the words of all pairs; rows of one key add up as in a join, null keys get 0."""
    monkeypatch.setattr(lexical, "_WORDS_AT_ONCE", 5, raising=False)
    texts = [("d0", "red red fox"), ("d1", "blue fox runs"), ("d1", "blue fox runs"), ("d1", "red"), ("d2", ""), (None, "red fox"), ("d3", "owl")]
    docs = spark.createDataFrame(texts, "key string, text string")
    asked = [("q0", "red fox fox"), ("q1", "blue"), ("q1", "blue runs"), ("q2", "zebra"), ("q3", None), (None, "red")]
    asks = spark.createDataFrame(asked, "key string, text string")
    pairs = [(q, d) for q in ("q0", "q1", "q2", "q3", "q9", None) for d in ("d0", "d1", "d2", "d3", None)] + [("q0", "d0")]
    split = [t.split() for _, t in texts]
    mean, df = sum(map(len, split)) / len(split), {w: sum(w in t for t in split) for t in split for w in t}
    raw = {w: np.log(len(split) - n + 0.5) - np.log(n + 0.5) for w, n in df.items()}
    idf = {w: v if v >= 0 else 0.25 * np.mean(list(raw.values())) for w, v in raw.items()}

    def due(q, d):
        each = [sum(idf.get(w, 0) * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / mean)) for w in (a or "").split())
                for k, a in asked if k == q is not None for key, t in zip((k for k, _ in texts), split) if key == d is not None]
        return sum(each) * pairs.count((q, d))

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = lexical.bm25_of_pairs(spark.createDataFrame(pairs, "query_key string, key string"), lexical.tokenised(asks, "text"), lexical.tokenised(docs, "text"))
        plan, rows = scored._jdf.queryExecution().executedPlan().toString(), scored.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    order = lambda r: [str(x) for x in r[:2]]
    assert sorted([(r.query_key, r.key, r.bm25) for r in rows], key=order) == sorted([(q, d, pytest.approx(due(q, d), abs=2e-9)) for q, d in pairs], key=order)
    assert not re.search(r"hashpartitioning\((query_)?key#\d+, term#\d+", plan)


def test_words_given_twice_count_twice():
    scorer = lexical.Scorer(pa.chunked_array([pa.array([[1, 2, 1], [1]] * 20, pa.list_(pa.int64()))]),
                            pa.chunked_array([pa.array([[1.0, 2.0, 1.0], [3.0]] * 20, pa.list_(pa.float64()))]), 2)
    rows = [[{"id": 1, "tf": 1}, {"id": 1, "tf": 1}, {"id": 2, "tf": 2}], [{"id": 1, "tf": 1}]]
    scorer.add(pa.chunked_array([pa.array(rows, WORDS)]), np.array([1.5, 1.5]), np.array(["a", "b"], object))
    one, two = 2.5 / 2.5, 5 / 3.5
    assert scorer.heads.score.tolist() == pytest.approx([4 * one + 2 * two, 2 * one, 6 * one, 3 * one] * 20, abs=1e-8)
    assert scorer.scored == 0
