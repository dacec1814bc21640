"""Token alignment against a plain recomputation, text by text."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from triagelake.llm import anchors

ODD = [None, "", " ", "a", "  a  b ", "x\n\n\ty", "c▁d", "<|endoftext|> <s> </s> <0x41> <unk>", "é ü ñ", "日本語 テキスト", " x  y 　z",
       "emoji 👩‍👩‍👧 ok", "w" * 3000, "long words " * 2000, "tab\tsep\r\nline", "don't you'll we've", "\x00\x01 \x7f", "123456 7,890.12", "ﬁ ﬀ ½", " ".join("ab" * 3)]


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeioustnrlABC,.'é-_0") for _ in range(rng.randint(1, 12)))
    rows = [(i, t) for i, t in enumerate(ODD)]
    rows += [(100 + i, " ".join(word() for _ in range(rng.randint(1, 80)))) for i in range(n)]
    rows += [(100, rows[-1][1]), (None, rows[-1][1]), (None, None)]
    return rows


def brute(rows):
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    level = anchors._byte_level()
    out, links = [], []
    for _, text in rows:
        due = b" " + (text or "").encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        words_a = [bytes(level[c] for c in a.id_to_token(i)) for i in ids_a]
        words_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(words_a) != due or b"".join(words_b) != due:
            out.append((0, 0, [], []))
            continue
        ends_a, ends_b = np.cumsum([len(w) for w in words_a]).tolist(), np.cumsum([len(w) for w in words_b]).tolist()
        groups, mine, x, y = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            p, q = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append((ids_a[x:p], ids_b[y:q]))
            mine.append((ids_a[p - 1], ids_b[q - 1]))
            x, y = p, q
        out.append((len(ids_a), len(ids_b), groups, mine))
        links += mine
    count, most = Counter(links), defaultdict(int)
    for (_, b_id), n in count.items():
        most[b_id] = max(most[b_id], n)
    found = []
    for (name, _), (n_a, n_b, groups, mine) in zip(rows, out):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        found.append((name, n_a, n_b, len(groups), len(mine), hashlib.sha256(text.encode()).hexdigest() if n_a else "",
                      sum(count[link] == most[link[1]] for link in mine), sum(count[link] for link in mine)))
    return Counter(found)


def of(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    return Counter(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("kept, size", [(0, 200), (5, 1 << 12), (200_000, 1 << 21)])
def test_alignment_equals_plain_recomputation(docs_of, monkeypatch, kept, size):
    monkeypatch.setattr(anchors, "KEPT_WINDOWS", kept)
    monkeypatch.setattr(anchors, "SLICE_BYTES", size)
    rows = corpus()
    assert of(anchors.aligned_digest(docs_of(rows))) == brute(rows)


def test_groups_are_real_output(docs_of):
    row = anchors.align(docs_of([(1, "hello world")])).first()
    assert row.n_a == 2 and row.groups.count(";") == row.n_groups - 1 and sum(row.times) == row.n_links


def test_empty_table(docs_of):
    assert anchors.aligned_digest(docs_of([])).collect() == []


def test_equal_hashes_do_not_join_windows(monkeypatch):
    """Windows are told apart by their ids, whatever their hashes."""
    monkeypatch.setattr(anchors, "_hash", lambda ids, first, seed: np.zeros(len(first), np.uint64))
    a, first_a = np.array([1, 2, 3, 1, 2, 4]), np.array([0, 2, 3, 5])
    b, first_b = np.array([7, 8, 7, 8]), np.array([0, 1, 2, 3])
    one, kind = anchors._distinct(a, first_a, b, first_b)
    tuples = [((1, 2), 7), ((3,), 8), ((1, 2), 7), ((4,), 8)]
    assert all(tuples[i] == tuples[one[k]] for i, k in enumerate(kind))


def test_links_are_bounded_by_the_vocabularies():
    assert 100_000 < anchors.possible_links() < 1_000_000
