"""Words of many texts at once, in numpy: ``[^\\x20\\x09-\\x0D]+`` over UTF-8 bytes.

A batch of texts is one byte buffer with offsets; word hashes and window hashes are
computed for the whole buffer. Null texts have no words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.array([0x243F6A8885A308D3, 0x13198A2E03707344], np.uint64)
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(step: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), step, np.uint64)]).cumprod(dtype=np.uint64)


@dataclass
class Words:
    data: np.ndarray  #: bytes of all texts
    starts: np.ndarray  #: of each word in data
    ends: np.ndarray
    bounds: np.ndarray  #: of each text: its words are bounds[i] up to bounds[i + 1]
    offsets: np.ndarray  #: of each text in data

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; the two kinds are independent."""
        out = np.full(len(self.starts), _RANDOM[which], np.uint64)
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        lanes = np.ndarray(len(self.data), "<u8", padded, strides=(1,))  # eight bytes from each byte on
        at, left, open_ = self.starts, self.ends - self.starts, slice(None)
        while len(at):
            value = lanes[at] & _MASK[np.minimum(left, 8)]
            out[open_] = mixed((out[open_] ^ value) * _STEP[which] + left.astype(np.uint64))
            more = np.flatnonzero(left > 8)
            open_ = more if isinstance(open_, slice) else open_[more]
            at, left = at[more] + 8, left[more] - 8
        return out

    def windows(self, hashes: np.ndarray, k: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they lie in one text."""
        n = max(0, len(hashes) - k + 1)
        total = np.zeros(n, np.uint64)
        for j, power in enumerate(_powers(_STEP[1 - which], k)):
            total += hashes[j:j + n] * power
        text = self.text_of
        return mixed(total), text[:n] == text[k - 1:] if n else np.zeros(0, bool)


def buffer_of(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words_of(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    data, offsets = buffer_of(texts)
    if lower:
        data = _LOWER[data]
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return Words(data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets), offsets)


_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of data[start:end] for each pair. Short strings are hashed together lane by
    lane; from 32 bytes on the library does it one by one."""
    import xxhash

    sizes = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data), "<u8", padded, strides=(1,))
    four = np.ndarray(len(data), "<u4", padded, strides=(1,))
    out = sizes.astype(np.uint64) + (np.uint64(seed) + _P5)
    for k in range(3):
        at = np.flatnonzero((sizes >= 8 * (k + 1)) & (sizes < 32))
        value = _turned(eight[starts[at] + 8 * k] * _P2, 31) * _P1
        out[at] = _turned(out[at] ^ value, 27) * _P1 + _P4
    at = np.flatnonzero(((sizes & 4) > 0) & (sizes < 32))
    out[at] = _turned(out[at] ^ (four[starts[at] + (sizes[at] & ~7)].astype(np.uint64) * _P1), 23) * _P2 + _P3
    for k in range(3):
        at = np.flatnonzero(((sizes & 3) > k) & (sizes < 32))
        out[at] = _turned(out[at] ^ (padded[starts[at] + (sizes[at] & ~3) + k].astype(np.uint64) * _P5), 11) * _P1
    out = (out ^ (out >> np.uint64(33))) * _P2
    out = (out ^ (out >> np.uint64(29))) * _P3
    out ^= out >> np.uint64(32)
    long = np.flatnonzero(sizes >= 32)
    if len(long):
        whole = data.tobytes()
        out[long] = [xxhash.xxh64_intdigest(whole[a:b], seed) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
    return out


def with_single_blanks(w: Words) -> Words:
    """The same words, with one space after each and nothing else between them."""
    sizes = w.ends - w.starts
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = int(ends[-1]) + 1 if len(ends) else 0
    if len(ends) and (w.starts[1:] - w.ends[:-1] == 1).all() and w.starts[0] == 0:
        data = np.full(n, 32, np.uint8)
        data[:min(n, len(w.data))] = w.data[:n]
        data[ends] = 32
    else:
        shift = np.repeat(w.starts - starts, sizes + 1)
        from_ = np.minimum(np.arange(n) + shift, max(0, len(w.data) - 1))
        data = w.data[from_] if n else np.zeros(0, np.uint8)
        data[ends] = 32
    return Words(data, starts, ends, w.bounds, np.append(starts, n)[w.bounds])
