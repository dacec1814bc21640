"""Alignment of two tokenizers' tokens, cut at white space both agree on.

Every text is tokenised whole by both: a space and the text by byte-level BPE (A), the
text by a byte-fallback piece model that adds the space itself (B). Where a token of A
and a token of B begin with the space mark at one byte, what stands before them ends
together in both; these places, verified by byte offsets, are the anchors. Anchors split
a document into windows, each a tuple of A ids and a tuple of B ids. The tokens' bytes
follow from the ids, so the alignment of a window (groups of tokens between shared ends,
and a link of the two tokens at each shared end) is made once per id tuple and kept; the
bound on what a worker keeps only sets how often it is made again.

Of two linked tokens one's bytes end the other's, so the vocabularies alone bound the
number of different links (``possible_links``), whatever the data: counts over all
documents are summed in Spark, sent to every task as arrays of at most that length, and
looked up per document. No text is shuffled.

Null and empty texts, and texts that the tokens of A or B do not spell byte for byte,
have no tokens: all numbers are 0 and groups is ''. Strings of special tokens inside
texts are plain text. Repeated rows are aligned and counted one by one, ids play no part
and may be null. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm import spread, tokens
from triagelake.llm.words import buffer_of, mixed
from triagelake.session import materialise, ship_package

PIECES = "piece_bpe_32k.model"
#: Windows whose alignment, and pieces of texts whose ids, a worker keeps.
KEPT_WINDOWS, KEPT_PIECES = 300_000, 500_000
#: Bytes of text that are aligned together.
SLICE_BYTES = 1 << 21

ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "link_a array<int>, link_b array<int>, times array<int>")


class Spelling:
    """The bytes of every id of a vocabulary."""

    def __init__(self, words: list[bytes]):
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(words), np.uint8)
        self.spaced = np.array([w[:1] == b" " for w in words])
        self.words = words

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return tokens.gathered(self.data, self.starts[ids], self.sizes[ids])


def _byte_level() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: bytes that print stand for
    themselves, the others are numbered from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class PieceEncoder(tokens.Encoder):
    """Ids by a piece model that puts a space before each text. No piece of it has a space
    mark behind another character, so no merge crosses the spaces at which texts are cut,
    and every cut piece begins with the space that the model adds."""

    def __init__(self, name: str):
        import public_tokenizers
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=name if os.path.isabs(name) else public_tokenizers.path(name))
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in n.lstrip("▁") for n in names):
            raise ValueError(f"{name}: a piece spans white space, its texts can't be cut there")
        self.words = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self._start()

    def ids_of(self, pieces: list[str]) -> list[list[int]]:
        return self.model.encode([p[1:] for p in pieces], num_threads=1)


class Tokenizers:
    def __init__(self, bpe: str, pieces: str):
        self.a, self.b = tokens.Encoder(bpe, plain=True), PieceEncoder(pieces)
        self.a.kept_pieces = self.b.kept_pieces = KEPT_PIECES
        stand_in, vocabulary = _byte_level(), self.a.tokenizer.get_vocab(with_added_tokens=True)
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for word, i in vocabulary.items():
            spelled[i] = bytes(stand_in[c] for c in word) if all(c in stand_in for c in word) else word.encode()
        self.spell_a, self.spell_b = Spelling(spelled), Spelling(self.b.words)
        # alignments kept: number by ids, groups as text, links with their bounds
        self.kept: dict[bytes, int] = {}
        self.texts = pa.array([], pa.string())
        self.links, self.bounds = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def encode(self, texts: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
        """Ids and bounds by A, the same by B, bytes of the spaced texts and their bounds."""
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts.cast(pa.large_string()), pa.scalar("", pa.large_string()))
        (a, a_bounds), (b, b_bounds) = self.a.encode(spaced), self.b.encode(spaced)
        return (a.astype(np.int64), a_bounds), (b.astype(np.int64), b_bounds), *buffer_of(spaced)


@lru_cache(maxsize=2)
def tokenizers(bpe: str = tokens.TOKENIZER, pieces: str = PIECES) -> Tokenizers:
    return Tokenizers(bpe, pieces)


def _only(values: np.ndarray, bounds: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and bounds of some of the texts."""
    sizes = np.diff(bounds)
    return values[np.repeat(kept, sizes)], np.concatenate([[0], np.cumsum(sizes[kept])])


def _spelled(pair, spelling: Spelling, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether the tokens of each text spell it byte for byte."""
    ids, bounds = pair
    ends = np.concatenate([[0], np.cumsum(spelling.sizes[ids])])[bounds]
    same = np.diff(ends) == np.diff(offsets)
    if not same.any():
        return same
    (mine, at), (due, _) = _only(spelling.bytes_of(ids), ends, same), _only(data, offsets, same)
    wrong = np.concatenate([[0], np.cumsum(mine != due)])
    same[same] = np.diff(wrong[at]) == 0
    return same


def _hash(ids: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of the ids of each window, by place."""
    place = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
    return np.add.reduceat(mixed(ids.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(24)) + np.uint64(seed << 56)), first)


def _distinct(a: np.ndarray, first_a: np.ndarray, b: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One window of each kind, and the kind of every window; equal hashes count only
    where the ids are equal as well."""
    _, one, kind = np.unique(mixed(_hash(a, first_a, 1)) ^ _hash(b, first_b, 2), return_index=True, return_inverse=True)
    same = np.ones(len(kind), bool)
    for ids, first in ((a, first_a), (b, first_b)):
        sizes = np.diff(np.append(first, len(ids)))
        same &= sizes == sizes[one][kind]
        limit = np.where(same, sizes, 0)
        start = np.cumsum(limit) - limit
        differs = tokens.gathered(ids, first, limit) != tokens.gathered(ids, first[one][kind], limit)
        same &= ~np.logical_or.reduceat(np.append(differs, False), start) | (limit == 0)
    odd = np.flatnonzero(~same)
    kind[odd] = len(one) + np.arange(len(odd))
    return np.append(one, odd), kind


def _joined(values: pa.Array, bounds: np.ndarray, mark: str) -> pa.Array:
    """Values between each two bounds, joined by ``mark``."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values), mark)


def _numbers(ids: np.ndarray) -> pa.Array:
    return pa.array(ids).cast(pa.string())


def _aligned_windows(t: Tokenizers, a: np.ndarray, bounds_a: np.ndarray, b: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of windows one after another: groups as text, link keys and the bounds of both."""
    ends_a, ends_b = np.cumsum(t.spell_a.sizes[a]), np.cumsum(t.spell_b.sizes[b])
    shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
    last_a, last_b = np.searchsorted(ends_a, shared), np.searchsorted(ends_b, shared)
    bounds = np.concatenate([[0], np.searchsorted(shared, ends_a[bounds_a[1:] - 1]) + 1])  # groups of each window
    sides = [_joined(_numbers(ids), np.append(0, last + 1), ",") for ids, last in ((a, last_a), (b, last_b))]
    return _joined(pc.binary_join_element_wise(*sides, "|"), bounds, ";"), a[last_a] << 32 | b[last_b], bounds


def _looked_up(t: Tokenizers, a: np.ndarray, first_a: np.ndarray, size_a: np.ndarray, b: np.ndarray, first_b: np.ndarray, size_b: np.ndarray):
    """Groups as text, link keys and their bounds of the windows given by their first
    ids and sizes; those not kept are aligned together, and kept while there is room."""
    bounds = np.concatenate([[0], np.cumsum(size_a + size_b + 1)])
    ids = np.full(bounds[-1], -1, np.int32)  # -1 parts the ids of A and B
    at = np.arange(len(ids)) - np.repeat(bounds[:-1], np.diff(bounds))
    of_a = at < np.repeat(size_a, np.diff(bounds))
    of_b = at > np.repeat(size_a, np.diff(bounds))
    ids[of_a], ids[of_b] = tokens.gathered(a, first_a, size_a), tokens.gathered(b, first_b, size_b)
    raw, edges = ids.tobytes(), (bounds * 4).tolist()
    keys = [raw[x:y] for x, y in zip(edges, edges[1:])]
    number = np.array([t.kept.get(k, -1) for k in keys], np.int64)
    new = np.flatnonzero(number < 0)
    known = len(t.texts)
    if len(new):
        number[new] = known + np.arange(len(new))
        text, links, ends = _aligned_windows(t, tokens.gathered(a, first_a[new], size_a[new]), np.concatenate([[0], np.cumsum(size_a[new])]),
                                             tokens.gathered(b, first_b[new], size_b[new]))
        texts = pa.concat_arrays([t.texts, text])
        links, ends = np.append(t.links, links), np.append(t.bounds, t.bounds[-1] + ends[1:])
        n = known + min(len(new), max(0, KEPT_WINDOWS - known))
        t.kept.update((keys[i], known + j) for j, i in enumerate(new[:n - known].tolist()))
        t.texts, t.links, t.bounds = pa.concat_arrays([texts.slice(0, n)]), links[:ends[n]].copy(), ends[:n + 1].copy()
    else:
        texts, links, ends = t.texts, t.links, t.bounds
    return texts, number, links, ends


def align_batch(t: Tokenizers, batch: pa.RecordBatch) -> pa.Table:
    """One row per text of the batch, in its order."""
    texts = batch.column("text")
    n = len(texts)
    counts = {name: np.zeros(n, np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
    written, links = None, {name: np.zeros(0, np.int32) for name in ("link_a", "link_b", "times")}
    sizes = np.zeros(n, np.int64)
    rows = np.flatnonzero(np.asarray(pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)))
    if len(rows):
        a, b, data, offsets = t.encode(texts.take(pa.array(rows)))
        whole = _spelled(a, t.spell_a, data, offsets) & _spelled(b, t.spell_b, data, offsets)
        rows = rows[whole]
        (a, a_bounds), (b, b_bounds) = _only(*a, whole), _only(*b, whole)
    if len(rows):
        counts["n_a"][rows], counts["n_b"][rows] = np.diff(a_bounds), np.diff(b_bounds)
        size_a, size_b = t.spell_a.sizes[a], t.spell_b.sizes[b]
        start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        anchors = np.intersect1d(start_a[t.spell_a.spaced[a]], start_b[t.spell_b.spaced[b]], assume_unique=True)
        first_a, first_b = np.searchsorted(start_a, anchors), np.searchsorted(start_b, anchors)
        window_bounds = np.searchsorted(first_a, a_bounds)  # every text begins with an anchor
        one, kind = _distinct(a, first_a, b, first_b)
        size_a, size_b = np.diff(np.append(first_a, len(a))), np.diff(np.append(first_b, len(b)))
        texts, number, all_links, ends = _looked_up(t, a, first_a[one], size_a[one], b, first_b[one], size_b[one])
        number = number[kind]
        held = np.diff(ends)[number]  # groups, each with a link
        distinct, of_link = np.unique(all_links, return_inverse=True)
        of_window = tokens.gathered(of_link, ends[number], held)
        link_bounds = np.concatenate([[0], np.cumsum(held)])[window_bounds]
        counts["n_links"][rows] = counts["n_groups"][rows] = np.diff(link_bounds)
        written = _joined(texts.take(pa.array(number)), window_bounds, ";")
        doc = np.repeat(np.arange(len(rows)), np.diff(link_bounds))
        pairs, times = np.unique(doc * len(distinct) + of_window, return_counts=True)
        sizes[rows] = np.bincount(pairs // len(distinct), minlength=len(rows))
        pairs = distinct[pairs % len(distinct)]
        links = {"link_a": (pairs >> 32).astype(np.int32), "link_b": (pairs & 0xFFFFFFFF).astype(np.int32), "times": times.astype(np.int32)}
    groups = pa.array([""], pa.string()).take(pa.array(np.zeros(n, np.int64)))
    if written is not None:
        is_whole = np.zeros(n, bool)
        is_whole[rows] = True
        groups = pc.replace_with_mask(groups, pa.array(is_whole), written)
    at = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return pa.table({
        "doc_id": batch.column("doc_id"), **{k: pa.array(v) for k, v in counts.items()}, "groups": groups,
        **{k: pa.ListArray.from_arrays(at, pa.array(v)) for k, v in links.items()}})


def align(docs: DataFrame, bpe: str = tokens.TOKENIZER, pieces: str = PIECES) -> DataFrame:
    """doc_id, token counts, groups as text (``a1,a2|b1;a3|b2,b3``, ids in order) and the
    document's different links with how often it holds them."""
    ship_package(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(bpe, pieces)
        for batch in spread.slices(batches, "text", SLICE_BYTES):
            yield from align_batch(t, batch).to_batches()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, ALIGNED)


def possible_links(bpe: str = tokens.TOKENIZER, pieces: str = PIECES) -> int:
    """How many id pairs can be linked at all: one's bytes end the other's."""
    t, total = tokenizers(bpe, pieces), 0
    count_a, count_b = ({}, {})
    for words, count in ((t.spell_a.words, count_a), (t.spell_b.words, count_b)):
        for w in words:
            count[w] = count.get(w, 0) + 1
    for w, n in count_a.items():
        total += n * sum(count_b.get(w[i:], 0) for i in range(len(w)))
    for w, n in count_b.items():
        total += n * sum(count_a.get(w[i:], 0) for i in range(1, len(w)))
    return total


def _links(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key and times of every link of the rows, and the bounds of each row's."""
    flat = {n: batch.column(n).combine_chunks() if isinstance(batch, pa.Table) else batch.column(n) for n in ("link_a", "link_b", "times")}
    key = flat["link_a"].flatten().to_numpy().astype(np.int64) << 32 | flat["link_b"].flatten().to_numpy()
    sizes = pc.list_value_length(flat["times"]).to_numpy(zero_copy_only=False)
    return key, flat["times"].flatten().to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def link_counts(aligned: DataFrame) -> DataFrame:
    """link (A id in the high half, B id in the low one) and n over all documents; tasks
    add up what they read before anything is shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, totals = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            key, times, _ = _links(batch)
            keys, which = np.unique(np.append(keys, key), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, which, np.append(totals, times))
            totals = sums
        yield pa.record_batch([pa.array(keys), pa.array(totals)], ["link", "n"])

    summed = aligned.select("link_a", "link_b", "times").mapInArrow(work, "link long, n long")
    return summed.groupBy("link").agg(F.sum("n").alias("n"))


def with_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` (stored, it is read twice) with n_best and count_sum in place of the links."""
    found = link_counts(aligned).orderBy("link").toArrow()  # at most possible_links() rows
    keys, n = found["link"].to_numpy(), found["n"].to_numpy()
    b = keys & 0xFFFFFFFF
    most = np.zeros(int(b.max(initial=-1)) + 1, np.int64)
    np.maximum.at(most, b, n)
    shared = aligned.sparkSession.sparkContext.broadcast((keys, n, n == most[b]))
    plain = [c for c in aligned.columns if c not in ("link_a", "link_b", "times")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.select(*plain).schema) + ", n_best long, count_sum long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = shared.value
        for batch in batches:
            key, times, bounds = _links(batch)
            at = np.searchsorted(keys, key)
            sums = [np.concatenate([[0], np.cumsum(v)]) for v in (times * best[at], times * n[at])]
            yield pa.record_batch([*[batch.column(c) for c in plain], *[pa.array(s[bounds[1:]] - s[bounds[:-1]]) for s in sums]],
                                  [*plain, "n_best", "count_sum"])

    return aligned.mapInArrow(work, schema)


def aligned_digest(docs: DataFrame) -> DataFrame:
    """A row per document with the digest of its groups in their place."""
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    rows = align(docs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "link_a", "link_b", "times")
    return with_counts(materialise(rows, "aligned"))
