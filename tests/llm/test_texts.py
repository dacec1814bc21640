"""SimHash, substring dedup and quality rules against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from triagelake.llm import outliers, repeats, simhash, spread

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " ", "\n\n", "a", "A b", "a\x0bb\tc  d\re", "é É ü", "long" * 5000, "w " * 3000, "same same same same", "日本 語 x y"]


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefg", k=rng.randint(1, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(ODD)]
    for i in range(len(rows), 160):
        text = prose(rng, rng.randint(0, 90))
        if i % 3 == 0:  # a passage of an earlier text
            words = (rng.choice(rows)[1] or "").split()
            a = rng.randint(0, max(0, len(words) - 1))
            text = f"{text}\n{' '.join(words[a:a + rng.randint(8, 40)])} {prose(rng, 5)}"
        if i % 7 == 0:  # a near copy
            words = (rows[-1][1] or "x").split()
            words[-1:] = ["changed"]
            text = " ".join(words)
        rows.append((i, text))
    rows += [(500, rows[40][1]), (501, rows[40][1]), (41, rows[41][1]), (None, rows[60][1]), (None, None)]
    rng.shuffle(rows)
    return rows


# -- SimHash ---------------------------------------------------------------------------


def brute_fingerprint(text, words=3):
    import xxhash

    t = WORD.findall((text or "").translate(LOWER))
    if not t:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(t[i:i + words]).encode(), 42) for i in range(max(1, len(t) - words + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_components(ids, linked):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(ids))]


def test_simhash_equals_brute_force(docs_of, corpus):
    got = simhash.with_hex(simhash.near_duplicates(docs_of(corpus))).collect()
    prints = [brute_fingerprint(t) for _, t in corpus]
    classes = brute_components([i for i, _ in corpus], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    due = Counter((i, f"{p:016x}", c) for (i, _), p, c in zip(corpus, prints, classes))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == due
    assert len({c for c in classes}) < len(corpus) - 5


def test_simhash_pairs_in_large_groups(monkeypatch):
    rng = np.random.default_rng(2)
    flips = [np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64) for _ in range(2)]
    keys = np.unique(np.uint64(0x0123456789ABCDEF) ^ flips[0] ^ flips[1])
    due = {(i, j) for i in range(len(keys)) for j in range(i + 1, len(keys)) if int(keys[i] ^ keys[j]).bit_count() <= 3}
    for dense in (16, 4096):
        monkeypatch.setattr(simhash, "DENSE", dense)
        assert {(int(a), int(b)) for i, j in simhash.near_pairs(keys, 3) for a, b in zip(i, j)} == due


def test_simhash_links_any_three_bits(spark):
    base = 0x5A5A00FF12345678
    rng = random.Random(1)
    prints = [base ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (0, 1, 2, 3, 3, 3) for _ in range(4)]
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    edges = simhash.link_edges(spark.createDataFrame([(p,) for p in signed], "fp long"))
    roots = {r.root for r in spread.components(edges, "t").collect()}
    assert len(roots) == 1


def test_components_of_a_long_chain(spark):
    n = 3000
    edges = spark.range(n - 1).selectExpr("id AS a", "id + 1 AS b").union(spark.range(50).selectExpr("id + 10000 AS a", "10000 AS b"))
    roots = dict(map(tuple, spread.components(edges, "chain").collect()))
    assert all(roots[i] == 0 for i in range(n)) and all(roots[10000 + i] == 10000 for i in range(50))


# -- substring dedup --------------------------------------------------------------------


def brute_repeats(rows, k=13):
    last = (1 << 63) - 1
    words = [(last if i is None else i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for p in range(len(w) - k + 1):
            g = tuple(w[p:p + k])
            first[g] = min(first.get(g, i), i)
    out = []
    for (i, w), (name, _) in zip(words, rows):
        gone = set()
        for p in range(len(w) - k + 1):
            if first[tuple(w[p:p + k])] < i:
                gone.update(range(p, p + k))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((name, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("chunk, bucket", [(3000, 400), (4 << 20, 1 << 20)])
def test_repeats_equal_brute_force(docs_of, corpus, monkeypatch, chunk, bucket):
    monkeypatch.setattr(spread, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(spread, "BUCKET_HASHES", bucket)
    out = repeats.cut_repeats(docs_of(corpus))
    got = Counter(map(tuple, out.select("doc_id", "n_words", "n_removed", repeats.kept_digest().alias("d")).collect()))
    assert got == brute_repeats(corpus)
    assert sum(n for _, _, n, _ in got) > 300
    same = {(r.doc_id, r.text) for r in out.where("n_removed = 0").collect()}
    assert same <= set(corpus)  # texts without repeats stay as they are


def test_repeats_of_a_passage_in_many_texts(docs_of):
    rng = random.Random(9)
    passage = prose(rng, 60)
    rows = [(i, f"{prose(rng, 10)} {passage} {prose(rng, 10)}") for i in range(200)]
    out = repeats.cut_repeats(docs_of(rows)).select("doc_id", "n_words", "n_removed", repeats.kept_digest().alias("d"))
    got = Counter(map(tuple, out.collect()))
    assert got == brute_repeats(rows)  # a short word beside the passage may repeat, too
    assert all(n == 0 if i == 0 else n >= 60 for i, _, n, _ in got)


def test_large_ids_beside_a_null_one(docs_of):
    """Ids stay exact whatever stands beside them; a null id comes after all ids."""
    rng = random.Random(4)
    a, b, c = (prose(rng, 20) for _ in range(3))
    big = 1 << 53
    rows = [(1, a), (None, a), (big, b), (big + 1, b), (None, c), (None, c), ((1 << 63) - 2, c)]
    out = repeats.cut_repeats(docs_of(rows, 1)).select("doc_id", "n_words", "n_removed", repeats.kept_digest().alias("d"))
    got = Counter(map(tuple, out.collect()))
    assert got == brute_repeats(rows)
    assert {(i, n) for i, _, n, _ in got} == {(1, 0), (None, 20), (big, 0), (big + 1, 20), ((1 << 63) - 2, 0)}


# -- quality rules ----------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    covered = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        again += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(covered)


def test_base_counts_equal_brute_force(corpus):
    texts = [t for _, t in corpus] + ["a | b\na | b\n\n\n #\n#", "x y z " * 8 + "\n" + "q " * 9]
    got = outliers.counts_of(pa.array(texts, pa.string()))
    assert list(zip(*(got[c].tolist() for c in outliers.COUNTS))) == [brute_counts(t) for t in texts]


def test_mcd_is_not_pulled_by_outliers():
    rng = np.random.default_rng(4)
    clean = rng.normal(0, [1.0, 2.0, 1.5, 1.0], (900, 4))
    mean, cov = outliers.mcd(np.concatenate([clean, np.full((200, 4), 40.0)]), np.ones(1100))
    assert np.abs(mean).max() < 0.3 and np.allclose(np.sqrt(np.diag(cov)), [1, 2, 1.5, 1], rtol=0.25)
    # a row that stands three times is three rows
    x, weight = np.unique(np.round(clean), axis=0, return_counts=True)
    once = outliers.mcd(x, weight.astype(float))
    assert np.allclose(once[0], np.round(clean).mean(axis=0), atol=0.4)


def test_concentration_steps_lower_the_determinant():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (300, 4)), rng.normal(6, 1, (60, 4))])
    start = outliers._moments(x, np.ones(360))
    best, mean, cov = outliers._concentrated(x, np.ones(360), *start, 50)
    assert best <= np.linalg.slogdet(start[1])[1] and np.abs(mean).max() < 0.5


def test_chi_square():
    assert abs(outliers.chi2_quantile(0.05, 4) - 9.4877) < 1e-3 and abs(outliers.chi2_tail(12.5916, 6) - 0.05) < 1e-4


def test_quality_keeps_prose_and_rejects_junk(docs_of, monkeypatch):
    monkeypatch.setattr(outliers, "MIN_GROUP", 50)
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(30, 300)), rng.choice(["en", None]), rng.choice(["a", "b", None])) for i in range(300)]
    rows += [(1000 + i, " ".join(w + "$$$" for w in prose(rng, 60).split()), "en", "a") for i in range(20)]
    rows += [(2000, None), (2001, ""), (2002, "few words"), (2003, "word " * 500)]
    for stored in (True, False):
        got = {r.doc_id: r for r in outliers.judged(docs_of(rows), stored).collect()}
        assert len(got) == len(rows)
        assert all(got[i].kept for i in range(300))
        assert not any(got[1000 + i].kept or got[1000 + i].base_failed for i in range(20))
        assert all(got[i].base_failed and not got[i].kept for i in range(2000, 2004))


@pytest.mark.parametrize("work", [
    lambda d: simhash.near_duplicates(d), lambda d: repeats.cut_repeats(d), lambda d: outliers.judged(d), lambda d: outliers.judged(d, False)])
def test_empty_tables(docs_of, work):
    assert work(docs_of([(1, "a")]).where("doc_id < 0")).collect() == []
