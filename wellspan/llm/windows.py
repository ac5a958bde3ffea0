"""Repeated word windows across documents, found through anchors.

An anchor rule picks, for every window of ``length`` words, one place inside it by the window's words
alone.  So equal windows, wherever they stand, have equal anchors with equal signatures, and windows
need to be compared only below one signature.  Neighbouring windows mostly share their anchor: one row
("instance") stands for all of them.  The steps:

1. instances (signature, hash of all words that its windows cover, document, first window, windows); those of a text
   that are equal are one row with all their places, so a passage repeated inside a text counts once;
2. signatures that occur once are dropped; where a signature has one content throughout, all windows
   of all documents but the smallest are repeats;
3. where a signature has several contents, copies of whole documents are settled first, a row each; of what is left
   equal contents are settled the same way, and one document of each content sends the hashes of its single windows,
   which settles the rest.

Words are compared by two independent hashes, polynomials of 61 bits modulo a prime with bases of their own: the
signature and the content of an instance, or the two hashes of a window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Ids, lean, materialize, text_or_empty
from .textcols import MIX, SEQ, SEQ2, U, Words, chunks, mix, prefix, ranges, tokenize

#: (words, first word of each word's document, end of it) -> (priority, signature, lo, hi) of the
#: possible anchors in text order: one is possible in a window that holds the words lo..hi.
Anchors = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def choose(priority: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, length: int, n: int) -> np.ndarray:
    """For each window at ``at`` the possible anchor with the least priority, leftmost on ties; -1 if it has none."""
    first = np.cumsum(np.bincount(lo + 1, minlength=n + 2))[at]
    last = np.cumsum(np.bincount(hi, minlength=n + 2))[at + length]
    span = last - first
    out = np.full(len(at), -1, np.int64)
    best, width = np.arange(len(priority)), 1
    while True:
        now = np.flatnonzero((span >= width) & (span < 2 * width))
        if len(now):
            left, right = best[first[now]], best[last[now] - width]
            out[now] = np.where(priority[right] < priority[left], right, left)
        if not (span >= 2 * width).any():
            return out
        left, right = best[: len(best) - width], best[width:]
        best = np.concatenate([np.where(priority[right] < priority[left], right, left), best[len(best) - width :]])
        width *= 2


def limits(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of each word's document."""
    counts = np.diff(w.at)
    return np.repeat(w.at[:-1], counts), np.repeat(w.at[1:], counts)


def instances(w: Words, anchors: Anchors, length: int) -> tuple[np.ndarray, ...]:
    """(signature, content, text, first window in its text, windows) of a chunk."""
    n = len(w.hash)
    first, end = limits(w)
    at = np.flatnonzero(np.arange(n) + length <= end)
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    pre = prefix(w.hash, SEQ2)
    priority, signature, lo, hi = anchors(w.hash, first, end)
    chosen = choose(priority, lo, hi, at, length, n)
    # A window without an anchor stands for itself.
    fresh = np.ones(len(at), bool)
    fresh[1:] = (chosen[1:] != chosen[:-1]) | (chosen[1:] < 0) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(fresh)
    last = np.append(head[1:], len(at)) - 1
    p1, p2, who = at[head], at[last], chosen[head]
    content = ranges(pre, p1, p2 + length, SEQ2)
    own = who < 0
    alone = ranges(prefix(w.hash, SEQ), p1, p2 + length, SEQ) if own.any() else content
    sig = np.where(own, alone, signature[np.maximum(who, 0)] if len(signature) else alone)
    content = np.where(own, content, mix(content ^ (np.where(own, 0, lo[np.maximum(who, 0)] - p1).astype(np.uint64) * U(MIX)) if len(lo) else content))
    text = np.searchsorted(w.at, p1, side="right") - 1
    return sig.view(np.int64), content.view(np.int64), text, (p1 - first[p1]), (p2 - p1 + 1)


def grouped(sig: np.ndarray, content: np.ndarray, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """First instance of each (text, signature, content), and the other places of those that have several (else null)."""
    if not len(sig):
        return np.zeros(0, np.int64), pa.nulls(0, pa.list_(pa.int32()))
    order = np.lexsort((at, content, sig, text))
    keys = [x[order] for x in (text, sig, content)]
    head = np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0)))
    size = np.diff(np.append(head, len(order)))
    rest = np.ones(len(order), bool)
    rest[head] = False
    ends = np.append(0, np.cumsum(size - 1)).astype(np.int32)
    places = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(size == 1, False)), pa.array(at[order][rest].astype(np.int32)))
    return order[head], places


def taken(column: pa.Array, at: np.ndarray) -> pa.Array:
    return column.take(pa.array(at))


def _instance_rows(anchors: Anchors, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 2):
                sig, content, text, at, n = instances(tokenize(part.column(2)), anchors, length)
                first, more = grouped(sig, content, text, at)
                sig, content, text, at, n = (x[first] for x in (sig, content, text, at, n))
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(content), taken(part.column(0), text), taken(part.column(1), text), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), more], ["sig", "content", "doc", "txt", "at", "n", "more"])

    return run


def _window_rows(length: int):
    """Hashes of the single windows in the listed spans of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 2):
                w = tokenize(part.column(2))
                at, counts, text = _spans(part.column(3), w.at)
                p = np.repeat(at - np.cumsum(counts) + counts, counts) + np.arange(counts.sum()) if len(at) else at
                text = np.repeat(text, counts)
                window, again = (pa.array(ranges(prefix(w.hash, base), p, p + length, base).view(np.int64)) for base in (SEQ, SEQ2))
                yield pa.RecordBatch.from_arrays([window, again, taken(part.column(0), text), taken(part.column(1), text), pa.array((p - w.at[text]).astype(np.int32))], ["window", "again", "doc", "txt", "at"])

    return run


def _spans(column: pa.Array, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word in the chunk, windows, text) of a list<struct<at, n, more>> column; more: other places with as many windows."""
    flat = column.flatten()
    per = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(per)), per)
    at, n, more = flat.flatten()
    times = more.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    at, n = (np.asarray(x).astype(np.int64) for x in (at, n))
    at, n, text = np.append(at, np.asarray(more.flatten()).astype(np.int64)), np.append(n, np.repeat(n, times)), np.append(text, np.repeat(text, times))
    order = np.argsort(text, kind="stable")
    return (at + starts[text])[order], n[order], text[order]


#: First window of an instance, its windows, and first windows of the same text's other instances that are equal.
SPAN, PLACES = "at int, n int, more array<int>", ("at", "n", "more")
REMOVED = "doc {id}, n_words long, n_removed long, kept_sha256 string, kept_text string"


def _removed_rows(length: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 2):
                w = tokenize(part.column(2))
                n = len(w.hash)
                at, counts, _ = _spans(part.column(3), w.at)
                cover = np.zeros(n + 1, np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + counts + length - 1, -1)
                gone = np.cumsum(cover[:n]) > 0
                kept = np.flatnonzero(~gone)
                text = np.searchsorted(w.at, kept, side="right") - 1
                final = np.ones(len(kept), bool)
                final[:-1] = text[1:] != text[:-1]
                # The bytes of kept words and, but for a text's last, one byte of the gap after each.
                mark = np.zeros(len(w.data) + 2, np.int64)
                np.add.at(mark, w.start[kept], 1)
                np.add.at(mark, w.end[kept] + ~final, -1)
                keep = np.cumsum(mark[: len(w.data)]) > 0
                gap = np.zeros(len(w.data) + 1, bool)
                gap[w.end[kept[~final]]] = True
                data = np.where(gap[:-1], 32, w.data).astype(np.uint8)[keep]
                size = np.bincount(text, weights=(w.end - w.start)[kept] + ~final, minlength=part.num_rows).astype(np.int64)
                to = np.cumsum(size)
                raw = memoryview(data.tobytes())
                pieces = [raw[b - a : b] for a, b in zip(size.tolist(), to.tolist(), strict=True)]
                words = np.diff(w.at)
                removed = words - np.bincount(text, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words), pa.array(removed), pa.array([hashlib.sha256(x).hexdigest() for x in pieces]), pa.array([bytes(x).decode() if with_text else None for x in pieces], pa.string())],
                    ["doc", "n_words", "n_removed", "kept_sha256", "kept_text"],
                )

    return run


def repeats_removed(docs: DataFrame, anchors: Anchors, length: int = 50, *, settle: Callable[[DataFrame], DataFrame], id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) with the repeats of smaller documents removed.

    ``settle`` finds, among instances, the signatures that occur more than once.
    """
    text, ids = text_or_empty(text_col), Ids(docs, id_col)
    base = docs.select(ids.encode().alias("doc"), F.xxhash64(text).alias("txt"), text.alias("text"))
    found = materialize(base.mapInArrow(lean(_instance_rows(anchors, length)), f"sig long, content long, doc {ids.type}, txt long, {SPAN}"), "window-instances")
    shared = materialize(settle(found), "window-signatures")
    both = found.join(shared, "sig")
    single = both.where("NOT mixed AND doc > smallest").select("doc", "txt", *PLACES)
    mixed = materialize(both.where("mixed").select(*found.columns), "window-mixed")
    # A document with the text and all these instances of a smaller one is settled as a whole, in one row; the rest is compared.
    inside = F.array_sort(F.collect_set(F.struct("at", "n", "sig", "content", "more")))
    whole_docs = mixed.groupBy("doc", "txt").agg(inside.alias("inside")).withColumn("print", F.xxhash64("inside"))
    whole_docs = materialize(whole_docs.select("doc", "txt", "print", F.transform("inside", lambda x: F.struct(*[x[c].alias(c) for c in PLACES])).alias("copied")), "window-documents")
    firsts = materialize(whole_docs.groupBy("txt", "print").agg(F.min("doc").alias("doc")).select("doc", "txt"), "window-firsts")
    copies = whole_docs.join(firsts, ["doc", "txt"], "left_anti").select("doc", "txt", "copied")
    mixed = materialize(mixed.join(firsts, ["doc", "txt"], "left_semi"), "window-compared")
    contents = materialize(mixed.groupBy("sig", "content").agg(F.min("doc").alias("smallest")), "window-contents")
    settled = mixed.join(contents, ["sig", "content"])
    equal = settled.where("doc > smallest").select("doc", "txt", *PLACES)
    open_ = settled.where("doc = smallest").groupBy("doc", "txt").agg(F.collect_list(F.struct(*PLACES)).alias("spans"))
    windows = base.join(open_, ["doc", "txt"]).select("doc", "txt", "text", "spans").mapInArrow(lean(_window_rows(length)), f"window long, again long, doc {ids.type}, txt long, at int")
    # One row per content and window, so a key has as many rows as there are different contents around it.
    windows = materialize(windows, "window-windows")
    first = windows.groupBy("window", "again").agg(F.min("doc").alias("smallest"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    late = windows.join(first, ["window", "again"]).where("doc > smallest").select("doc", "txt", "at", F.lit(1).alias("n"), F.lit(None).cast("array<int>").alias("more"))
    spans = single.unionByName(equal).unionByName(late).groupBy("doc", "txt").agg(F.collect_set(F.struct(*PLACES)).alias("spans"))
    none = F.array().cast(f"array<struct<{SPAN}>>")
    both_spans = F.concat(F.coalesce("spans", none), F.coalesce("copied", none)).alias("spans")
    whole = base.join(spans, ["doc", "txt"], "left").join(copies, ["doc", "txt"], "left").select("doc", "txt", "text", both_spans)
    out = whole.mapInArrow(lean(_removed_rows(length, with_text)), REMOVED.format(id=ids.type))
    return out.select(ids.decode("doc").alias("doc_id"), "n_words", "n_removed", "kept_sha256", *(["kept_text"] if with_text else []))
