"""Substring deduplication by recompression.

Rounds of recompression name runs of equal symbols, then pairs of neighbours whose name bits are 0 and
1.  A name is a 64-bit hash of what it stands for, so names are global: every task gives equal
substrings the same interior symbols with no table of names to exchange, and a lost task is redone alone.
Each symbol carries the words its making depended on; inside any window that holds those words the
same symbol arises, and so high-level symbols anchor the windows that share them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textcols import MIX, SEQ, U, mix, prefix, ranges
from .windows import repeats_removed

ROUNDS = 3
#: Symbols of more words than this are paired no more.
LONGEST = 16


def _merged(symbols, join: np.ndarray, name) -> tuple[np.ndarray, ...]:
    """Symbols after those marked in ``join`` are merged with their left neighbours; ``name`` names a group."""
    sym, start, end, lo, hi, doc_start, doc_end = symbols
    head = np.flatnonzero(~join)
    tail = np.append(head[1:], len(sym)) - 1
    named = name(sym, head, tail)
    before = np.maximum(head - 1, 0)
    after = np.minimum(tail + 1, len(sym) - 1)
    # What a symbol is depends on its neighbours; at a text's limit on what no window inside can see.
    new_lo = np.where(start[head] == doc_start[head], doc_start[head] - 1, lo[before])
    new_hi = np.where(end[tail] == doc_end[tail], doc_end[tail] + 1, hi[after])
    return named, start[head], end[tail], new_lo, new_hi, doc_start[head], doc_end[head]


def recompressed(words: np.ndarray, first: np.ndarray, end: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """(name, start, end, lo, hi, ...) of the symbols after some rounds, in text order."""
    n = len(words)
    at = np.arange(n)
    symbols = (words, at, at + 1, at, at + 1, first, end)
    for r in range(rounds):
        sym, start = symbols[0], symbols[1]
        inner = np.zeros(len(sym), bool)
        inner[1:] = start[1:] != symbols[5][1:]
        run = inner.copy()
        run[1:] &= sym[1:] == sym[:-1]
        symbols = _merged(symbols, run, lambda s, a, b: np.where(b > a, mix(s[a] * U(SEQ) + (b - a).astype(np.uint64)), s[a]))
        sym, start = symbols[0], symbols[1]
        bit = (mix(sym + U((r + 1) * MIX % 2**64)) & U(1)).astype(bool)
        short = symbols[2] - start <= LONGEST
        pair = np.zeros(len(sym), bool)
        pair[1:] = ~bit[:-1] & bit[1:] & short[:-1] & short[1:] & (start[1:] != symbols[5][1:])
        symbols = _merged(symbols, pair, lambda s, a, b: np.where(b > a, mix(s[a] * U(SEQ) ^ mix(s[b])), s[a]))
    return symbols


def anchors(words: np.ndarray, first: np.ndarray, end: np.ndarray):
    """Top symbols as anchors; the signature is that of all words on which the symbol depends."""
    name, _, _, lo, hi, _, _ = recompressed(words, first, end)
    pre = prefix(words, SEQ)
    signature = ranges(pre, np.clip(lo, 0, len(words)), np.clip(hi, 0, len(words)), SEQ)
    return mix(name ^ U(SEQ)), signature, lo, hi


def shared_signatures(found: DataFrame) -> DataFrame:
    """Signatures of more than one instance, by sums that are combined before the shuffle."""
    sums = found.groupBy("sig").agg(F.count("*").alias("rows"), (F.min("content") != F.max("content")).alias("mixed"), F.min("doc").alias("smallest"))
    return sums.where("rows > 1").drop("rows")


def dedup_substrings(docs: DataFrame, length: int = 50, *, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (with ``with_text`` also kept_text).

    A word is removed if a window of ``length`` words that covers it also starts in a document with a smaller
    id.  Windows are judged on the input.  kept_text holds the kept words joined by one space.
    Null and empty texts have no words; a null id counts as larger than any other, and comes back null; rows with
    equal ids don't remove from each other; repeated rows get equal results; an empty table gives no rows.
    """
    return repeats_removed(docs, anchors, length, settle=shared_signatures, id_col=id_col, text_col=text_col, with_text=with_text)
