"""Packing of tables whose lengths are clustered in file order."""

from __future__ import annotations

import pytest

from triagelake.llm import packing


@pytest.mark.parametrize("shard", [100, 2000])
def test_clustered_lengths_are_packed_together(spark, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD_PIECES", shard)
    words = [1499] * 300 + [499] * 300  # and the end: a long and a short one fit into 2048
    rows = [(i, " ".join(["the"] * n), "en", "s", 0, "x", "y") for i, n in enumerate(words)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard string, score string").coalesce(2)).collect()
    assert {r.length for r in got} == {1500, 500} and sorted(r.doc_id for r in got) == list(range(600))
    assert len({r.sequence_id for r in got}) <= 302
    used: dict[int, int] = {}
    for r in got:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 2048


@pytest.mark.parametrize("shard", [40])
def test_lengths_that_leave_room_everywhere(spark, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD_PIECES", shard)
    rows = [(i, " ".join(["the"] * 699), "en", "s", 0, "x", "y") for i in range(301)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard string, score string")).collect()
    assert sorted(r.doc_id for r in got) == list(range(301)) and len({r.sequence_id for r in got}) == 151
