"""Groups of a batch that no query can need are skipped, and nothing else."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from test_retrieval import brute_rrf, rounded, unit
from triagelake.operators import grid, pruning, retrieval

VIEWS = ("vec_a", "vec_b")


class Captured(Exception):
    pass


def clustered(seed, n, kinds=12, dims=16, spread=0.05, centres=None):
    rng = np.random.default_rng(seed)
    centres = unit(np.random.default_rng(5).normal(size=(kinds, dims))) if centres is None else centres
    return unit(centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, dims)))


def odd(seed, n):
    """Ties, zeros and lengths far from one."""
    rng = np.random.default_rng(seed)
    rows = rng.integers(-1, 2, (n, 5)).astype(float) * rng.choice([0.0, 1.0, 1.0, 1e4, 1e-4], (n, 1))
    rows[::7] = rows[0]
    return rows


def table(name, **views):
    n = len(next(iter(views.values())))
    return pa.table({name: [f"{name[0]}{i:05d}" for i in range(n)], **{v: x.tolist() for v, x in views.items()}})


def cell_of(monkeypatch, call):
    def capture(queries, corpus, query_key, key, make_cell, *rest, **more):
        raise Captured(make_cell)

    monkeypatch.setattr(grid, "on_grid", capture)
    with pytest.raises(Captured) as stopped:
        call()
    monkeypatch.undo()
    return stopped.value.args[0]


def batches(right, size):
    return [right.slice(lo, size) for lo in range(0, len(right), size)]


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("make", [clustered, odd, lambda s, n: unit(np.random.default_rng(s).normal(size=(n, 9)))])
def test_bounds_hold_for_every_product(make, seed):
    rows, queries = make(seed, 700), make(seed + 50, 200)
    groups = pruning.Groups(rows, len(queries))
    lower, upper = groups.bounds(queries)
    assert sorted(np.concatenate(groups.members)) == list(range(700)) and len(groups.members) > 1
    for g, cols in enumerate(groups.members):
        assert (np.diff(cols) > 0).all()
        products = rounded(queries @ rows[cols].T)
        assert (products <= upper[:, g, None]).all() and (products >= lower[:, g, None]).all()


@pytest.mark.parametrize("rows, queries", [(63, 900), (900, 63), (0, 0), (1, 1)])
def test_small_sides_are_one_group(rows, queries):
    groups = pruning.Groups(np.ones((rows, 3)), queries)
    assert [len(m) for m in groups.members] == [rows] and np.isposinf(groups.bounds(np.ones((queries, 3)))[1]).all()


def test_missing_numbers_are_never_a_reason_to_skip():
    rows = clustered(1, 400)
    rows[3, 0] = np.nan
    heads, tally = grid.Heads(300, 4), pruning.Tally()
    heads.bars[:] = 2.0
    for _ in retrieval._open_products(clustered(2, 300), rows, heads, tally):
        pass
    alone = pruning.Groups(rows, 300)
    whole = next(len(m) for m in alone.members if 3 in m)
    assert tally.scored >= 300 * whole


@pytest.mark.parametrize("make, skips", [(clustered, True), (odd, False)])
@pytest.mark.parametrize("boosts", [{}, {"kind": 0.2}])
def test_top_k_of_a_run_is_the_plain_one(spark, monkeypatch, make, skips, boosts):
    empty = spark.createDataFrame([], "key string, vec_a array<double>, kind string")
    make_cell = cell_of(monkeypatch, lambda: retrieval.top_k(empty, empty, "vec_a", 5, boosts))
    queries, corpus = make(1, 256), make(2, 3000)
    kinds = [np.array(["x", "y", None], dtype=object)[np.random.default_rng(n).integers(0, 3, n)] for n in (256, 3000)]
    cell = make_cell(table("query_key", vec_a=queries).append_column("kind", pa.array(kinds[0], pa.string())))
    right = table("key", vec_a=corpus).append_column("kind", pa.array(kinds[1], pa.string()))
    for batch in batches(right, 500):
        cell.add(batch)
    got = defaultdict(set)
    for r in cell.result().to_pylist():
        got[r["query_key"]].add((r["key"], round(r["score"], 6), round(r["sim"], 6)))
    sims = rounded(queries @ corpus.T)
    same = (kinds[0][:, None] == kinds[1][None, :]) & (kinds[0] != None)[:, None]  # noqa: E711
    scores = rounded(sims + boosts.get("kind", 0.0) * same)
    for q in range(256):
        best = np.lexsort((np.arange(3000), -scores[q]))[:5]
        assert got[f"q{q:05d}"] == {(f"k{i:05d}", round(scores[q, i], 6), round(sims[q, i], 6)) for i in best}
    assert cell.tally.pairs == 256 * 3000
    if skips:
        assert cell.tally.scored < cell.tally.pairs / 2


def test_list_heads_of_a_run_hold_both_similarities(spark, monkeypatch):
    empty = spark.createDataFrame([], "key string, vec_a array<double>, vec_b array<double>")
    make_cell = cell_of(monkeypatch, lambda: retrieval.list_heads(empty, empty, 7, VIEWS))
    other = unit(np.random.default_rng(9).normal(size=(10, 16)))
    q = [clustered(1, 200), clustered(3, 200, centres=other)]
    c = [clustered(2, 2000), clustered(4, 2000, centres=other)]
    monkeypatch.setattr(grid, "SCORE_CELLS", 20_000)
    cell = make_cell(table("query_key", vec_a=q[0], vec_b=q[1]))
    for batch in batches(table("key", vec_a=c[0], vec_b=c[1]), 400):
        cell.add(batch)
    sims = [rounded(a @ b.T) for a, b in zip(q, c)]
    got = {(r["query_key"], r["view"], r["key"]): (r["sim_a"], r["sim_b"]) for r in cell.result().to_pylist()}
    due = {}
    for i in range(200):
        for view in (0, 1):
            for j in np.lexsort((np.arange(2000), -sims[view][i]))[:7]:
                due[f"q{i:05d}", float(view), f"k{j:05d}"] = (sims[0][i, j], sims[1][i, j])
    assert got.keys() == due.keys()
    assert all(got[x] == pytest.approx(due[x], abs=2e-9) for x in due)
    assert cell.tally.scored < cell.tally.pairs / 2


@pytest.mark.parametrize("case", ["one topic", "own topics", "ties"])
def test_fusion_of_clustered_vectors_is_the_plain_one_and_counts_few(spark, monkeypatch, case):
    # both views of a ticket speak of one topic, or each of its own
    a = clustered(1, 1500)
    b = clustered(1, 1500, centres=unit(np.random.default_rng(6).normal(size=(12, 16)))) if case == "one topic" else clustered(11, 1500)
    if case == "ties":
        a, b = a[np.arange(1500) % 300], b[np.arange(1500) % 110]
    rows = [(f"t{i:05d}", a[i].tolist(), b[i].tolist()) for i in range(1500)]
    schema = "key string, vec_a array<double>, vec_b array<double>"
    queries, corpus = (spark.createDataFrame(x, schema) for x in (rows[:500], rows[500:]))
    got = defaultdict(list)
    seen, real = [], grid.on_grid
    monkeypatch.setattr(grid, "on_grid", lambda *x, **more: seen.append(x) or real(*x, **more))
    for r in retrieval.rrf_top(queries, corpus, 10, 4, runs=2).orderBy("query_key", "rk").collect():
        got[r.query_key].append((r.key, r.rank_a, r.rank_b))
    assert got == brute_rrf([(k, np.array(x), np.array(y)) for k, x, y in rows[:500]],
                            [(k, np.array(x), np.array(y)) for k, x, y in rows[500:]], 10, 4)

    # the second pass again, in this process
    asking, theirs, _, _, make_cell = seen[1][:5]
    cell = make_cell(asking.toArrow())
    for batch in batches(grid.sorted_by(theirs.toArrow(), "key"), 500):
        cell.add(batch)
    assert cell.tally.pairs == 2 * 500 * 1000 and cell.tally.scored <= cell.tally.pairs
    if case == "one topic":
        assert cell.tally.scored < cell.tally.pairs / 2


def test_only_products_near_a_bar_are_rounded_and_rounding_decides(spark, monkeypatch):
    """Rows come in bundles whose products differ after the ninth decimal alone."""
    rng, n, m = np.random.default_rng(3), 100, 4000
    queries = unit(rng.normal(size=(n, 8)))
    corpus = unit(rng.normal(size=(m // 40, 8)))[np.arange(m) % (m // 40)] + 4e-10 * rng.normal(size=(m, 8))
    sizes, plain = [], retrieval._rounded
    monkeypatch.setattr(retrieval, "_rounded", lambda x: sizes.append(np.size(x)) or plain(x))
    patch = pytest.MonkeyPatch()
    empty = spark.createDataFrame([], "key string, vec_a array<double>, vec_b array<double>")
    top = cell_of(patch, lambda: retrieval.top_k(empty, empty, "vec_a", 30))(table("query_key", vec_a=queries))
    heads = cell_of(patch, lambda: retrieval.list_heads(empty, empty, 30, VIEWS))(table("query_key", vec_a=queries, vec_b=queries))
    for batch in batches(table("key", vec_a=corpus, vec_b=corpus), 1000):
        top.add(batch)
        heads.add(batch)
    scores = rounded(queries @ corpus.T)
    due = {(f"q{i:05d}", f"k{j:05d}") for i in range(n) for j in np.lexsort((np.arange(m), -scores[i]))[:30]}
    assert {(r["query_key"], r["key"]) for r in top.result().to_pylist()} == due
    assert {(r["query_key"], r["key"]) for r in heads.result().to_pylist() if r["view"] == 0} == due
    # the rows ahead of some contenders of a query
    at = rng.choice(m, 50, replace=False)
    asked = pa.chunked_array([pa.array([[{"pos": i, "key": f"k{j:05d}", "in_a": True, "sim": scores[0, j]} for i, j in enumerate(at)]])])
    counted = retrieval._Contenders(asked)
    counted.see(np.array([f"k{j:05d}" for j in range(m)], object))
    counted.count(np.arange(50), np.zeros(50, int), queries[:1] @ corpus.T, np.arange(m), retrieval._near(queries, corpus))
    order = np.lexsort((np.arange(m), -scores[0]))
    assert counted.ahead.tolist() == [int(np.flatnonzero(order == j)[0]) for j in at]
    assert sum(sizes) < 3 * n * m / 4  # of three products a pair
