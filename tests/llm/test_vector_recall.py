"""Links that the nearest centroids do not share, and the audit that has to see them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from triagelake.llm import vectors


def test_links_beyond_the_nearest_centroids_are_found(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 10)
    angle = np.random.default_rng(4).uniform(0, 2 * np.pi, 400)
    x = np.stack([np.cos(angle), np.sin(angle)], axis=1).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in vectors.near_duplicates(table).collect()}
    m = vectors.matrix(pa.array(x.tolist(), pa.list_(pa.float32())), 2)
    due = (m @ m.T >= 0.95).sum(axis=1) - 1
    assert [got[i].n_links for i in range(400)] == due.tolist() and due.min() > 20
    assert {r.audited_recall for r in got.values()} == {1.0}


def test_audit_sees_rare_links_and_averages_over_nodes(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 24))
    x[1490:] = x[:10] + 0.01 * rng.normal(size=(10, 24))  # ten pairs among 1,500
    nodes = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "node long, copies long, embedding array<float>")
    nothing = spark.createDataFrame([], "node long, links long")
    assert vectors._audit(nodes, nothing, 24, 0.95) == 0.0
    assert vectors._audit(nodes.where("node < 1490"), nothing, 24, 0.95) is None
    half = spark.createDataFrame([(i, 1) for i in range(10)], "node long, links long")
    assert vectors._audit(nodes, half, 24, 0.95) == 0.5
