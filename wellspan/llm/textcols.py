"""Vectorised words of Arrow text columns (numpy, no Python loop over words).

A chunk of texts is one byte array.  Word limits come from a byte table.  A word's hash runs over its
bytes eight at a time through a bijection (a keyed BLAKE2 for words above LONG_WORD bytes); hashes of word
sequences are polynomials modulo the prime 2**61 - 1 over prefix sums.  (Modulo 2**64 every odd base fails
on Thue-Morse strings.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
#: Odd multipliers of word and sequence hashes, bases of two independent polynomials, and of the final mixing.
BASE, SEQ, SEQ2, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9
#: The prime that sequence hashes are taken modulo.
PRIME = (1 << 61) - 1
#: Bytes from which a word is hashed by itself.
LONG_WORD = 64
#: Bytes of text handled at once; a longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> U(31))
    x = x * U(MIX)
    x ^= x >> U(29)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(32))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & U(PRIME)) + (x >> U(61))
    return np.where(x >= U(PRIME), x - U(PRIME), x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME of numbers below it."""
    a1, a0, b1, b0 = a >> U(31), a & U(0x7FFFFFFF), b >> U(31), b & U(0x7FFFFFFF)
    middle = a1 * b0 + a0 * b1
    return _reduced(U(2) * (a1 * b1) + (middle >> U(30)) + ((middle & U(0x3FFFFFFF)) << U(31)) + a0 * b0)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo PRIME for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        both = []
        for b in (base % PRIME, pow(base, -1, PRIME)):
            p = np.ones(1, np.uint64)
            while len(p) < max(n, 1 << 16):
                p = np.concatenate([p, _times(p, U(pow(b, len(p), PRIME)))])
            both.append(p)
        have = _POWERS[base] = (both[0], both[1])
    return have


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of values[i] * base**i modulo PRIME, with a leading 0."""
    out = np.zeros(len(values) + 1, np.uint64)
    terms = _times(_reduced(values), _powers(base, len(values))[0][: len(values)])
    low, high = np.cumsum(terms & U(0x3FFFFFFF)), np.cumsum(terms >> U(30))
    out[1:] = _reduced(_reduced((high >> U(31)) + ((high & U(0x7FFFFFFF)) << U(30))) + low)
    return out


def ranges(pre: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hashes of the ranges [start, end): equal contents, equal hashes, wherever they stand."""
    back = _powers(base, len(pre))[1]
    return mix(_times(_reduced(pre[end] + (U(PRIME) - pre[start])), back[start]) + (end - start).astype(np.uint64) * U(MIX))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end)."""
    padded = np.append(data, np.zeros(8, np.uint8))
    lanes = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    size = end - start
    out = size.astype(np.uint64) * U(BASE)
    left = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    done = 0
    while len(left):
        lane = lanes[start[left] + done]
        short = size[left] - done
        shift = (8 * (8 - np.minimum(short, 8))).astype(np.uint64)
        out[left] = mix((out[left] ^ (lane << shift >> shift)) * U(SEQ) + U(done + 1))
        done += 8
        left = left[short > 8]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, key=b"words").digest(), "little")
    return out


@dataclass
class Words:
    """Words of a chunk of texts; ``at[i]:at[i + 1]`` are the words of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray
    hash: np.ndarray

    def joined(self, keep: np.ndarray, lo: int, hi: int) -> bytes:
        """The kept words among lo..hi, joined by one space."""
        i = np.flatnonzero(keep[lo:hi]) + lo
        data = self.data
        return b" ".join([data[a:b].tobytes() for a, b in zip(self.start[i].tolist(), self.end[i].tolist(), strict=True)])


def tokenize(texts: pa.Array, white: np.ndarray = WHITE, lower: bool = False) -> Words:
    """Words of a string array; null is a text without words."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = LOWER[data]
    inside = ~white[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    limits = offsets[1:-1]
    limits = limits[(limits > 0) & (limits < len(data))]
    first[limits] = inside[limits]
    last[limits - 1] = inside[limits - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(data, start, end, np.searchsorted(start, offsets), word_hashes(data, start, end))


def chunks(batch: pa.RecordBatch, text: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each, so that memory stays bounded."""
    if not batch.num_rows:
        return
    column = batch.column(text)
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, batch.num_rows)
        yield batch.slice(at, to - at)
        at = to
