"""Metrics from confusion counts."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from triagelake.operators import evaluation as E


def counts(spark, pairs):
    df = spark.createDataFrame([("t", a, b) for a, b in pairs], "target string, true_label string, pred_label string")
    return E.confusion(df)


PAIRS = [("a", "a")] * 4 + [("a", "x")] + [("b", "a")] * 2 + [("c", "c")]  # b is never predicted, x only predicted


def test_undefined_scores_and_label_universe(spark):
    null_true = {r.label: r.f1 for r in E.per_class(counts(spark, PAIRS)).collect()}
    assert null_true["b"] is None and set(null_true) == {"a", "b", "c"}
    zero_union = {r.label: r.f1 for r in E.per_class(counts(spark, PAIRS), labels="union", undefined="zero").collect()}
    assert zero_union["b"] == 0.0 and zero_union["x"] == 0.0
    f_a = 2 * (4 / 6) * (4 / 5) / (4 / 6 + 4 / 5)
    assert E.summary(counts(spark, PAIRS)).first().macro_f1 == pytest.approx((f_a + 1) / 2)
    assert E.summary(counts(spark, PAIRS), labels="union", undefined="zero").first().macro_f1 == pytest.approx((f_a + 1) / 4)
    assert E.summary(counts(spark, PAIRS)).first().accuracy == pytest.approx(5 / 8)


def macro(rows, labels):
    total = 0.0
    for l in labels:
        tp = sum(a == l and b == l for a, b in rows)
        fp = sum(a != l and b == l for a, b in rows)
        fn = sum(a == l and b != l for a, b in rows)
        total += 2 * tp / (2 * tp + fp + fn) if tp else 0.0
    return total / len(labels)


def test_bootstrap_replays_the_draws_over_rows(spark, monkeypatch):
    monkeypatch.setattr(E, "DRAWS_PER_TASK_ROW", 3)
    got = E.bootstrap_macro_f1(counts(spark, PAIRS), replicates=20).first()
    rows, labels = sorted(PAIRS), sorted({x for p in PAIRS for x in p})
    scores = []
    for r in range(20):
        at = [int(hashlib.md5(f"{r}:{d}".encode()).hexdigest()[:15], 16) % len(rows) for d in range(len(rows))]
        scores.append(macro([rows[i] for i in at], labels))
    want = np.percentile(scores, [2.5, 50, 97.5])
    assert [got.ci_low, got.ci_mid, got.ci_high] == pytest.approx(list(np.round(want, 4)), abs=1e-4)


def test_routing_shares_sum_to_the_whole(spark):
    df = spark.createDataFrame([("D",), ("D",), ("L",)], "r string")
    got = {r.r: (r.n_tickets, r.pct) for r in E.routing_share(df, ["r"]).collect()}
    assert got == {"D": (2, 66.7), "L": (1, 33.3)}


def test_confusion_matrix_is_filled(spark):
    rows = spark.createDataFrame(PAIRS, "true_label string, pred_label string")
    got = {r.true_label: (r.a, r.c, r.x) for r in E.confusion_matrix(rows, ["a", "c", "x"]).collect()}
    assert got == {"a": (4, 0, 1), "b": (2, 0, 0), "c": (0, 1, 0)}
