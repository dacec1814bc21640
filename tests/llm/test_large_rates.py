"""Mixing of sources whose rate is far above one."""

from __future__ import annotations

import hashlib
import math

from triagelake.llm import mixing


def test_rates_above_a_thousand_draw_from_their_poisson(spark, docs_of):
    rows = [(i, "t", "en", "few" if i < 40 else "many") for i in range(4000)]
    weights = spark.createDataFrame([("few", 1300.0), ("many", 1.0)], "source string, weight double")
    got = mixing.replicate(docs_of(rows), weights, epochs=12.0).where("source = 'few'").groupBy("doc_id", "rate").count().collect()
    rate = round(1300 / 1301 * 4000 * 12 / 40, 9)
    assert rate > 1000 and {r.rate for r in got} == {rate} and len(got) == 40
    for r in got:
        u = int(hashlib.md5(f"{r.doc_id}:{mixing.SEED}".encode()).hexdigest()[:13], 16) / 2**52
        k, c = -1, 0.0
        while c <= u:
            k += 1
            c += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        assert abs(r["count"] - k) <= (1 if abs(c - u) < 1e-9 else 0)


def test_distribution_function_is_continuous_in_its_start(spark, monkeypatch):
    rates = spark.createDataFrame([("a", 300.0)], "source string, rate double")
    whole = mixing.poisson_table(rates).first()
    monkeypatch.setattr(mixing, "LARGEST_MEAN", 299.0)
    part = mixing.poisson_table(rates).first()
    assert whole["first"] == 0 and part["first"] > 60
    assert max(abs(a - b) for a, b in zip(whole.cdf[part["first"]:], part.cdf)) < 1e-11
