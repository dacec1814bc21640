"""Secrets against a character-by-character scan, and in planted layers."""

from __future__ import annotations

import base64
import bz2
import gzip
import lzma
import random
import zlib
from urllib.parse import quote

import numpy as np
import pytest

from triagelake.llm import layers

KEY = "AKIA" + "Q7RZ" * 4
ODD = [None, "", " ", "password=abcde", "PassWord = 'abcdef'", "token:token=abcdef secret==abc", "api_key: x api-key=123456 apikey\"=\"A.b/c+d",
       "AKIAAKIA" + "A" * 12 + "z" + KEY, "akia" + "A" * 20, "f" * 23 + " " + "0" * 24 + "g" + "a1" * 40, "é ü secret:   ÄÖ secret: abcdeé secret: abcdef",
       "toKen=abcdef", "ſecret=abcdef", "token =\tabcdef", "passwd\"  :  \"hunter22\"" + "x" * 50, "日本 token=語 token=abcdef12"]


def walk(text):
    """Base spans by hand, without patterns."""
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    upper = set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    lower = text.translate({65 + i: 97 + i for i in range(26)})
    out, at = [], 0
    while at < len(text):
        end = None
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if lower.startswith(word, at):
                p = at + len(word)
                p += p < len(text) and text[p] in "\"'"
                while text[p:p + 1] == " ":
                    p += 1
                if text[p:p + 1] in (":", "="):
                    p += 1
                    while text[p:p + 1] == " ":
                        p += 1
                    p += text[p:p + 1] in ("\"", "'")
                    q = p
                    while q < len(text) and text[q] in value:
                        q += 1
                    if q > p:
                        end = q
                        if q - p >= 6:
                            out.append(("assign", at, q))
        at = end or at + 1
    for kind, start, letters, least in (("access", "AKIA", upper, 20), ("hex", "", set("0123456789abcdef"), 24)):
        at = 0
        while at < len(text):
            q = at + len(start)
            if text.startswith(start, at):
                while q < len(text) and text[q] in letters:
                    q += 1
            if q > at + len(start):
                if q - at >= least:
                    out.append((kind, at, q))
                at = q
            else:
                at += 1
    return sorted(out, key=lambda s: (s[1], layers.KINDS.index(s[0])))


def rows_of(df):
    return sorted(((r.doc_id, [(s.kind, s.start, s.end, s.depth) for s in r.spans]) for r in df.collect()), key=str)


def test_base_spans_equal_a_walk(docs_of):
    rng = random.Random(2)
    bits = ["token", "secret", "PASSWD", "api_key", "apikey", ":", "=", " ", "\"", "'", "AKIA", "A1", "f0", "abc", "é", "-", "\n", KEY, "0123456789abcdef"]
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, "".join(rng.choices(bits, k=rng.randint(1, 60)))) for i in range(300)]
    rows += [(100, rows[-1][1]), (None, rows[-1][1]), (None, None), (7, "x " * 200_000 + "token=abcdef " + "y" * 100_000)]
    got = [(i, [s[:3] for s in spans if s[3] == 0]) for i, spans in rows_of(layers.scan(docs_of(rows)))]
    assert sorted(got, key=str) == sorted(((i, walk(t or "")) for i, t in rows), key=str)


def wrapped(raw, n=76):
    text = base64.b64encode(raw).decode()
    return "\n".join(text[i:i + n] for i in range(0, len(text), n))


SECRET = f"the password = correct-horse and {KEY} here"
B64 = lambda raw: base64.b64encode(raw).decode()
URL = lambda t: "".join(f"%{b:02X}" for b in t.encode())
U = lambda t: "".join(f"\\u{ord(c):04x}" for c in t)


@pytest.mark.parametrize("hidden", [
    URL(SECRET), U(SECRET), B64(SECRET.encode()), base64.urlsafe_b64encode(("ÿþ? " + SECRET).encode()).decode().rstrip("="),
    B64(gzip.compress(SECRET.encode())), B64(zlib.compress(SECRET.encode())), B64(bz2.compress(SECRET.encode())), B64(lzma.compress(SECRET.encode())),
    B64(gzip.compress(zlib.compress(gzip.compress(SECRET.encode())))), B64(B64(SECRET.encode()).encode()), URL(B64(U(SECRET).encode())),
    quote(quote(quote(SECRET))), U(URL(B64(gzip.compress(URL(SECRET).encode())))),
    "".join(f"%{b:02x}" for b in gzip.compress(SECRET.encode())), "".join(f"\\x{b:02x}" for b in SECRET.encode()), wrapped((SECRET + " and so on " * 9).encode()),
    "".join(f"\\u{{{ord(c):x}}}" for c in SECRET), "".join(f"\\U{ord(c):08x}" for c in SECRET),
])
def test_nested_layers(hidden):
    text = f"clean é words {hidden} more words"
    spans, n_layers, unopened = layers.scan_text(text)
    a, b = text.index(hidden), text.index(hidden) + len(hidden)
    inside = [(k, depth) for k, start, end, depth in spans if a <= start < end <= b]
    assert {0, 1} <= {k for k, _ in inside} and any(depth for _, depth in inside) and unopened == 0 and n_layers > 1
    assert [s[:3] for s in spans if s[3] == 0] == sorted(layers.finds(text), key=lambda s: (s[1], s[0]))


def test_zstd_layer():
    import zstandard

    spans, _, _ = layers.scan_text(B64(zstandard.ZstdCompressor().compress(SECRET.encode())))
    assert {s[0] for s in spans} >= {0, 1}


def test_spans_are_mapped_to_the_characters_they_come_from():
    text = "é " + URL("x ") + "pass" + URL("wo") + "rd=abc%64ef tail"
    (kind, start, end, depth), = [s for s in layers.scan_text(text)[0] if s[3]]
    assert (kind, text[start:end]) == (0, "pass%77%6Frd=abc%64ef")
    inner = "xx token=abcdef yy"
    text = "ä " + B64(inner.encode()) + " z"
    (kind, start, end, depth), = [s for s in layers.scan_text(text)[0] if s[3]]
    bits = [i for i in range(len(B64(inner.encode()))) if 3 * 8 < (i + 1) * 6 and i * 6 < 15 * 8]
    assert (start, end) == (2 + bits[0], 2 + bits[-1] + 1)
    text = "\\ud83d\\ude00 token=\\u0061bcdef \\ud83d lone"
    assert [text[a:b] for _, a, b, d in layers.scan_text(text)[0] if d] == ["token=\\u0061bcdef"]


def test_a_partly_broken_run_keeps_what_it_can():
    text = "%ff%70assword=abc%fe%64efghi"
    assert [text[a:b] for _, a, b, d in layers.scan_text(text)[0] if d] == []
    text = "%ff%70assword=abc%64efghi%fe"
    assert [text[a:b] for _, a, b, d in layers.scan_text(text)[0] if d] == ["%70assword=abc%64efghi"]


def test_cycles_end(monkeypatch):
    """An archive that unpacks to itself, and a text whose base64 unpacks to the text."""
    quine = b"\x1f\x8b\x08" + bytes(range(40))
    assert_closed = layers.Budget()
    monkeypatch.setattr(layers, "_PACKED", ((layers.re.compile(rb"\x1f\x8b\x08"), lambda raw, limit: raw),))
    assert layers.unpacked(quine, assert_closed) is None
    text = B64(quine)
    monkeypatch.setattr(layers, "_PACKED", ((layers.re.compile(rb"\x1f\x8b\x08"), lambda raw, limit: f"token=abcdef {text}".encode()),))
    spans, n_layers, _ = layers.scan_text(text)
    assert [(s[0], s[1], s[2]) for s in spans] == [(0, 0, len(text))] and n_layers == 2


def test_an_endless_archive_is_counted(monkeypatch):
    monkeypatch.setattr(layers, "DECODED_BYTES", 10_000)
    bomb = B64(gzip.compress(b"a b " * 100_000))
    spans, _, unopened = layers.scan_text(f"token=abcdef {bomb} {URL(SECRET)}")
    assert unopened > 0 and {s[0] for s in spans if s[3]} >= {0, 1}


def test_clean_texts_stay_clean(docs_of):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join("".join(map(chr, rng.integers(97, 123, rng.integers(1, 30)))) for _ in range(200)) + " 100% \\u \\x %zz ====") for i in range(40)]
    assert all(not spans for _, spans in rows_of(layers.scan(docs_of(rows))))
    assert layers.scan(docs_of([])).collect() == []
