"""Chat format, WARC, packing, mixing and vectors: round trips and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagelake.llm import chat, mixing, packing, tokens, vectors, warc

# -- chat -------------------------------------------------------------------------------

CONTENTS = [
    "plain", "", None, "<|im_end|>", "<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|x", "a <", "|>", "<|", "<||", "\\<|\\", "\n<|im_end|>\n",
    "dollar $1 \\1", "é 日本 🙂 <|🙂|>", "x" * 5000 + "<|im_start|>"]


def test_chat_round_trip(spark):
    roles = ["user", "assistant", "system", None, "tool\nwith <|im_end|> %0A"]
    rows = [(c, t, roles[(c + t) % 5], CONTENTS[(3 * c + t) % len(CONTENTS)], "extra") for c in range(12) for t in range(1 + c % 6)]
    rows += [(50, 1, "user", "tie b", ""), (50, 1, "user", "tie a", ""), (50, None, "assistant", "no number", ""), (51, 0, "user", "twice", ""), (51, 0, "user", "twice", ""), (None, 0, "user", "x", "")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(table)).collect()}
    turns = defaultdict(list)
    for c, t, role, text, _ in rows:
        turns[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(turns)
    for c, list_ in turns.items():
        list_.sort()
        source = "".join(f"{role}\n{text}\n" for _, role, text in list_)
        learned = "".join(text for _, role, text in list_ if role == "assistant")
        r = got[c]
        assert r.identical and r.n_turns == len(list_), (c, list_)
        assert r.turns_sha256 == hashlib.sha256(source.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_chat_markers_stand_only_where_the_grammar_puts_them(spark):
    table = spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(CONTENTS)], "conv_id long, turn long, role string, text string")
    text = chat.format_conversations(table).first().formatted
    assert text.count("<|") == 2 * len(CONTENTS) == text.count("<|im_start|>") + text.count("<|im_end|>")
    assert chat.format_conversations(table.where("false")).collect() == []


def test_chat_parser_refuses_what_breaks_the_grammar(spark):
    bad = ["<|im_start|>user\nx", "x<|im_start|>user\na<|im_end|>\n", "<|im_start|>user<|im_end|>\n", "<|im_start|>u\na<|b<|im_end|>\n", "<|im_start|>u\na<|im_end|>\nrest"]
    assert all(r.t is None for r in spark.createDataFrame([(b,) for b in bad], "x string").select(chat.parse(F.col("x")).alias("t")).collect())


# -- WARC -------------------------------------------------------------------------------


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ENTRIES_PER_RANGE", 7)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 5)
    long, exact, short = "p" * 2000, "é" * 500, "s" * 999
    rows = [(i, f"http://h{i % 3}.example.com/{i % 4}", f"<p>{i}</p>\r\n\r\nWARC/1.1\r\n" * (i % 5)) for i in range(30)]
    rows += [(100, "HTTPS://A.b/x", long), (101, "u", long), (102, None, long), (103, "a\r\nb %0A", short), (104, "u", short), (105, "u", exact), (106, "u", exact), (107, "", None)]
    rows += [(102, "again", long), (None, "none", "no id"), (110, "big", "日" * 200_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(4)
    got = warc.archived(pages).orderBy("place").collect()
    assert [r.place for r in got] == list(range(len(rows)))
    order = [(r.url_key, r.captured, -1 if r.page_id is None else r.page_id) for r in got]
    assert order == sorted(order)
    last = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= 1000 and i is not None:
            last[html] = max(last.get(html, i), i)
    due = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        refers = last.get(html) if last.get(html) != i else None
        due[(i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if refers is not None else "response", refers)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == due
    assert sum(r.record_type == "revisit" for r in got) == 3
    assert warc.archived(pages.where("false")).collect() == []


def test_loser_tree_merges_like_sorting():
    rng = random.Random(8)
    for k in range(0, 9):
        runs = [sorted([(rng.choice("abc"), rng.randint(0, 5), rng.choice([None, 1, 2]), j) for _ in range(rng.randint(0, 20))], key=warc.order_of) for j in range(k)]
        got = list(warc.merged(runs))
        assert [warc.order_of(x) for x in got] == sorted(warc.order_of(x) for r in runs for x in r)
        assert Counter(got) == Counter(x for r in runs for x in r)


def test_damaged_payload_is_an_error(spark):
    import gzip

    page = spark.createDataFrame([(1, "u", "hello")], "page_id long, url string, html string")
    text = warc.captures(page)
    raw = text.select(warc.record(text).alias("v")).first().v.encode() + b"\r\n\r\n"
    assert list(warc.entries(gzip.compress(raw), "a"))[0][2:4] == (1, 5)
    with pytest.raises(ValueError):
        list(warc.entries(gzip.compress(raw.replace(b"hello", b"hellO")), "a"))


# -- packing ----------------------------------------------------------------------------


@pytest.mark.parametrize("shard", [40, 2000])
def test_packing(docs_of, small, monkeypatch, shard):
    from tokenizers import Tokenizer
    import public_tokenizers

    monkeypatch.setattr(packing, "SHARD_PIECES", shard)
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    rows += [(9000, None), (9001, ""), (9002, "  a \n\n b  c "), (9003, "it's 'll    x"), (9004, "w " * 9000), (9005, "dup"), (9005, "dup"), (None, "no id")]
    got = packing.pack(docs_of(rows)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    due = Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        edges = [0, *range(first, len(ids), 2048), len(ids)] if len(ids) > 2048 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            due[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == due
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(r.length for r in got) // 2048)
    assert len(sequences) <= least + 1


def test_crossover_keeps_every_piece_once():
    rng, py = np.random.default_rng(3), random.Random(3)
    length = [py.randint(1, 900) for _ in range(120)]
    parents = []
    for k in range(2):
        bins = []
        packing.best_fit(bins, py.sample(range(120), 120), length, 2048)
        parents.append(bins)
    for child in (packing.crossover(*parents, length, 2048, rng), packing.mutated(parents[0], length, 2048, rng)):
        assert sorted(i for b in child for i in b) == list(range(120))
        assert all(sum(length[i] for i in b) <= 2048 for b in child)
    best = packing.evolve(length, 2048, parents, 1)
    assert packing.fitness(best, length, 2048) <= min(packing.fitness(p, length, 2048) for p in parents)


def test_worker_keeps_a_bounded_number_of_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "KEPT_PIECES", 50)
    encoder = tokens.Encoder(tokens.TOKENIZER)
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(12)]
    for t in texts:
        ids, _ = encoder.encode(pa.array([t]))
        assert ids.tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids
        assert len(encoder.hashes) <= 60


def test_packing_nothing(docs_of):
    assert packing.pack(docs_of([(1, "a")]).where("false")).collect() == []


# -- mixing -----------------------------------------------------------------------------


def test_mixing_equals_brute_force(docs_of):
    import math

    rows = [(i, "t", "en", ["a", "a", "a", "b", None][i % 5]) for i in range(400)] + [(None, None, None, "b"), (7, "t", "en", "a")]
    n = Counter(r[3] for r in rows)
    weight = {s: c**mixing.EXPONENT for s, c in n.items()}
    due = Counter()
    for i, _, _, s in rows:
        name = "null" if i is None else str(i)
        u = int(hashlib.md5(f"{name}:{mixing.SEED}".encode()).hexdigest()[:13], 16) / 2**52
        rate = weight[s] / sum(weight.values()) * len(rows) / n[s]
        k, p = 0, math.exp(-rate)
        c = p
        while c <= u:
            k += 1
            p *= rate / k
            c += p
        for j in range(k):
            due[(i, s, k, j, hashlib.md5(f"{name}/{j}:{mixing.SEED}".encode()).hexdigest())] += 1
    got = mixing.replicate(docs_of(rows))
    assert Counter((r.doc_id, r.source, r.n_copies, r.copy, r.shuffle_key) for r in got.collect()) == due
    assert got.columns[:7] == ["doc_id", "text", "lang", "source", "n_chars", "shard", "score"]


def test_mixing_to_given_weights(spark, docs_of):
    rows = [(i, "t", "en", "big" if i % 10 else "small") for i in range(4000)]
    weights = spark.createDataFrame([("big", 1.0), ("small", 1.0), ("absent", 5.0)], "source string, weight double")
    got = Counter(r.source for r in mixing.replicate(docs_of(rows), weights).collect())
    assert set(got) == {"big", "small"} and all(abs(v - 2000) < 250 for v in got.values())
    only = mixing.replicate(docs_of(rows), weights.where("source = 'small'"), epochs=2.0)
    assert abs(only.count() - 800) < 150  # of the sources that take part
    assert mixing.replicate(docs_of(rows).where("false")).collect() == []


# -- vectors ----------------------------------------------------------------------------


@pytest.mark.parametrize("block", [2000, 60])
def test_vector_links_and_recall(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "SHARD", 150)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 16))
    x = np.concatenate([centres[rng.integers(0, 30, 500)] + 0.12 * rng.normal(size=(500, 16)), centres[:1] + 0.1 * rng.normal(size=(150, 16))]).astype(np.float32)
    rows = [(int(i), v.tolist(), 0) for i, v in enumerate(x)] + [(900, x[3].tolist(), 1), (901, x[3].tolist(), 2), (902, (2 * x[3]).tolist(), 2)]
    odd = [(910, None, 0), (911, [], 0), (912, [0.0] * 16, 0), (913, [1.0, None] + [0.0] * 14, 0), (914, [float("inf")] * 16, 0), (915, [float("nan")] * 16, 0)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, links int").repartition(3)
    got = {r.vec_id: r for r in vectors.near_duplicates(table).collect()}
    m = np.array([r[1] for r in rows], float)
    m /= np.linalg.norm(m, axis=1)[:, None]
    near = m @ m.T >= 0.95
    np.fill_diagonal(near, False)
    ids = np.array([r[0] for r in rows])
    due, found = near.sum(axis=1), np.array([got[i].n_links for i in ids])
    assert (found <= due).all() and found.sum() >= 0.97 * due.sum() and due.sum() > 5000
    label = ids.copy()
    for _ in range(50):
        label = np.minimum(label, np.where(near, label[None], 1 << 40).min(axis=1))
    assert np.mean([got[i].component_id == c for i, c in zip(ids, label)]) > 0.97
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(910, 916))
    assert got[900].audited_recall >= 0.9
    assert vectors.near_duplicates(table.where("false")).collect() == []


def test_robust_pruning_keeps_the_nearest_and_no_node_itself():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    out = vectors.robust_pruned(x, 1)
    near = x @ x.T
    np.fill_diagonal(near, -2)
    assert (out[:, 0] == near.argmax(axis=1)).all() and not (out == np.arange(200)[:, None]).any()
    assert len(vectors.range_search(x[:1], np.full((1, 1), -1), x[:1], 0.9)[0]) == 1
