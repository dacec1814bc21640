"""Links between fingerprints on as many rows as make the optimizer plan in stages."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from triagelake.llm import simhash
from triagelake.llm.spread import components


def test_no_link_is_lost_between_tasks(spark):
    """Pairs that differ in one bit of either segment meet under a key that only one has."""
    n, rng = 30_000, np.random.default_rng(1)
    a = rng.integers(0, 2**64, n, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 32, n, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(32, 64, n, dtype=np.uint64))
    prints = spark.createDataFrame([(x,) for x in np.concatenate([a, b]).view(np.int64).tolist()], "fp long").distinct()
    root = {r.node: r.root for r in components(simhash.link_edges(prints), "test").collect()}
    a, b = a.view(np.int64).tolist(), b.view(np.int64).tolist()
    assert sum(root.get(x, x) != root.get(y, y) for x, y in zip(a, b)) == 0


def test_probes_are_not_sent_to_all_tasks(spark):
    """A table of fingerprints under the broadcast threshold, whose 66 probes each are not."""
    prints = spark.range(40_000).select(F.xxhash64("id").alias("fp"))
    edges = simhash.link_edges(prints)
    assert "Broadcast" not in edges._jdf.queryExecution().executedPlan().toString()
