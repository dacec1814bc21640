"""Token ids of whole texts by a public byte-level BPE tokenizer.

A byte-level BPE never joins what stands before a single space to what follows, so a
text is cut at such spaces and every distinct piece of a batch is encoded once. Each
Python worker keeps the ids of pieces it has met, up to a bound; the bound only sets
how often a piece is encoded again. Null texts are empty."""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from triagelake.llm.words import Words, buffer_of

TOKENIZER = "byte_bpe_50k.json"
#: Pieces whose ids a worker keeps.
KEPT_PIECES = 1_200_000
#: Pieces that are encoded in one call.
AT_ONCE = 8192


class Encoder:
    kept_pieces: int | None = None  #: in place of KEPT_PIECES

    def __init__(self, name: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
        self._start()
        if plain:  # strings of special tokens are ordinary text
            self.tokenizer.encode_special_tokens = True

    def _start(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # ascending
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)  # of each piece, in ids
        self.ids = np.zeros(0, np.uint32)

    def ids_of(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _add(self, pieces: list[str], hashes: np.ndarray) -> None:
        """Encode pieces (with ascending hashes, none of them kept yet) and keep them."""
        parts, sizes = [self.ids], []
        for a in range(0, len(pieces), AT_ONCE):
            found = self.ids_of(pieces[a:a + AT_ONCE])
            sizes += map(len, found)
            parts.append(np.fromiter(chain.from_iterable(found), np.uint32))
        sizes = np.array(sizes, np.int64)
        at = np.searchsorted(self.hashes, hashes)
        self.starts = np.insert(self.starts, at, len(self.ids) + np.cumsum(sizes) - sizes)
        self.sizes = np.insert(self.sizes, at, sizes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.ids = np.concatenate(parts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the bounds of each text in them."""
        data, offsets = buffer_of(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        cut = np.zeros(len(data), bool)
        cut[1:-1] = (data[1:-1] == 32) & ~blank[:-2] & ~blank[2:]
        edges = offsets[:-1][np.diff(offsets) > 0]
        cut[edges[1:] - 1] = False  # a space that ends a text
        cut[edges] = True
        starts = np.flatnonzero(cut)
        pieces = Words(data, starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets), offsets)
        distinct, first, which = np.unique(pieces.hashes(), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        new = np.flatnonzero(self.hashes[at] != distinct) if len(self.hashes) else np.arange(len(distinct))
        kept = self.hashes, self.starts, self.sizes, self.ids
        if len(new):
            raw = data.tobytes()
            self._add([raw[a:b].decode() for a, b in zip(pieces.starts[first[new]].tolist(), pieces.ends[first[new]].tolist())], distinct[new])
        at = np.searchsorted(self.hashes, distinct)[which]
        sizes = self.sizes[at]
        bounds = np.concatenate([[0], np.cumsum(sizes)])[pieces.bounds]
        ids = gathered(self.ids, self.starts[at], sizes)
        if len(self.hashes) > (self.kept_pieces or KEPT_PIECES):  # full: frequent pieces were met before
            self.hashes, self.starts, self.sizes, self.ids = kept
        return ids, bounds


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


@lru_cache(maxsize=2)
def encoder(name: str = TOKENIZER) -> Encoder:
    return Encoder(name)
