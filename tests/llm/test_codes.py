"""Vector codes against plain k-means in integers."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from triagelake.llm import ballcodes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x string, error string"


def brute(rows, entries, parts=4, rounds=4, scale=1024):
    """rows of (vec_id, vector, label), in the order of ids, widths all alike."""
    kept = [(i, [math.floor(scale * float(np.float32(v))) for v in x], label) for i, x, label in rows
            if x is not None and all(v is not None and math.isfinite(v) for v in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    width = -(-len(kept[0][1]) // parts)
    cut = [[(x + [0] * (width * parts - len(x)))[p * width:(p + 1) * width] for p in range(parts)] for _, x, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((square(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        at = assign()
        for p in range(parts):
            members = defaultdict(list)
            for c, found in zip(cut, at):
                members[found[p][1]].append(c[p])
            for k, m in members.items():
                books[p][k] = [sum(col) // len(m) for col in zip(*m)]
    at = assign()
    by_label = defaultdict(int)
    for (_, _, label), found in zip(kept, at):
        by_label[label] += sum(d for d, _ in found)
    flat = ",".join(str(v) for b in books for e in b for v in e)
    out = [(i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), by_label[label]) for (i, _, label), found in zip(kept, at)]
    return sorted(out, key=str), hashlib.sha256(flat.encode()).hexdigest()


def run(spark, rows, entries, parts=3):
    df = spark.createDataFrame([(i, x, label, "c", "x", "e") for i, x, label in rows], SCHEMA).repartition(parts)
    made = ballcodes.compress(df, entries)
    found = ballcodes.with_label_error(made.codes).collect()
    return sorted(((r.vec_id, r.code.hex() if r.code is not None else None, r.error, r.label_error) for r in found), key=str), made


def vectors(n, dim, kind, seed=0):
    rng = np.random.default_rng(seed)
    if kind == "clusters":
        x = rng.normal(size=(9, dim))[rng.integers(0, 9, n)] + rng.normal(size=(n, dim)) * 0.01
    elif kind == "lattice":  # many ties and equal rows
        x = rng.integers(-2, 3, (n, dim)) / 4
    else:
        x = rng.normal(size=(n, dim))
    return [(i, x[i].tolist(), None if i % 3 == 0 else int(i % 5)) for i in range(n)]


@pytest.mark.parametrize("kind", ["clusters", "lattice", "normal"])
@pytest.mark.parametrize("at_once", [7, 1 << 16])
def test_codes_equal_plain_k_means(spark, monkeypatch, kind, at_once):
    monkeypatch.setattr(ballcodes, "AT_ONCE", at_once)
    rows = vectors(150, 8, kind)
    bad = float("nan"), float("inf"), None
    odd = [(1000 + i, [0.0] * 7 + [v], 1) for i, v in enumerate(bad)] + [(2000, None, 1), (None, [0.5] * 8, None), (3, rows[3][1], 9), (3, rows[4][1], 9)]
    rows = rows + odd
    random.Random(1).shuffle(rows)
    found, made = run(spark, rows, 20)
    due, digest = brute(rows, 20)
    assert found == due and made.digest() == digest


def test_large_components_and_other_widths(spark):
    rows = [(i, [float(x) for x in np.random.default_rng(i).integers(-300_000, 300_000, 4)], 1) for i in range(30)]
    found, made = run(spark, rows, 8)
    due, digest = brute(rows, 8)
    assert found == due and made.digest() == digest
    more, _ = run(spark, rows + [(98, [1.0], 2), (99, [3e38] * 4, 2), (97, [], None)], 8)
    assert [r for r in more if r[0] < 97] == found
    assert sorted(r for r in more if r[0] >= 97) == [(97, None, None, None), (98, None, None, None), (99, None, None, None)]


def test_widths_that_are_no_multiple_and_few_vectors(spark):
    rows = vectors(5, 6, "normal")
    found, made = run(spark, rows, 256)
    due, digest = brute(rows, 256)
    assert found == due and made.digest() == digest
    back = {r.vec_id: r.vector for r in ballcodes.restored(made.codes, made.codebooks).collect()}
    assert all(np.allclose(back[i], [*np.floor(1024 * np.float32(x)) / 1024, 0, 0], atol=0.5) for i, x, _ in rows)


def test_empty_table(spark):
    assert run(spark, [], 8)[0] == [] and run(spark, [(1, None, 1)], 8)[0] == []


def test_stable_cores_and_rings_spare_comparisons(monkeypatch):
    """On clustered parts most points are compared with few entries, none wrongly."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-4000, 4000, (64, 16))
    points = centres[rng.integers(0, 64, 5000)] + rng.integers(-5, 6, (5000, 16))
    compared, plain = [], ballcodes._squared
    monkeypatch.setattr(ballcodes, "_squared", lambda a, b, w: compared.append(len(a) * len(b)) or plain(a, b, w))
    at, near = ballcodes.Balls.around(centres, None).assign(points, np.zeros(len(points), np.uint8))
    full = plain(points, centres, 16)
    assert (at == full.argmin(1)).all() and (near == full.min(1)).all()
    reach = np.zeros(64, np.int64)
    np.maximum.at(reach, at, near)
    balls = ballcodes.Balls.around(centres, reach)
    compared.clear()
    again, _ = balls.assign(points, at)
    assert (again == at).all() and balls.neighbours.max() == 1 and sum(compared) == 0
