"""Quality classifier from weak labels: expectation-maximisation, then a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Ids, materialize, text_or_empty
from .textcols import U, Words, chunks, mix, prefix, ranges, tokenize

#: Documents the linear scorer is trained on at most (those with the least text hashes), and its hashed features.
TRAIN_DOCS, DIMENSIONS = 20_000, 1 << 15
STEPS, PRIOR_GOOD = 60, 0.8
LABELLERS = ("length", "symbols", "lines", "variety", "word_length", "common_word", "sentences")
#: Bins of a measure; the first len(LABELLERS) * BINS features are bins, the others hashed words.
BINS = 64
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_END = np.zeros(256, bool)
_END[list(b".!?")] = True


class Measured:
    """Measures of a chunk of texts, and its words counted by text."""

    def __init__(self, texts: pa.Array):
        w = self.words = tokenize(texts)
        docs = len(w.at) - 1
        self.n = np.diff(w.at)
        n = np.maximum(1, self.n).astype(float)
        self.doc = np.repeat(np.arange(docs), self.n)
        per = lambda x: np.bincount(self.doc, weights=x, minlength=docs)
        order = np.lexsort((w.hash, self.doc))
        new = np.append(True, (w.hash[order][1:] != w.hash[order][:-1]) | (self.doc[order][1:] != self.doc[order][:-1]))[: len(order)]
        head = np.flatnonzero(new)
        #: Distinct words: text, hash, count.
        self.of, self.hash, self.count = self.doc[order][head], w.hash[order][head], np.diff(np.append(head, len(order)))
        top = np.zeros(docs)
        np.maximum.at(top, self.of, self.count)
        symbols = np.append(0, np.cumsum(_SYMBOL[w.data]))
        self.all = np.stack(
            [
                self.n.astype(float),
                per(symbols[w.end] - symbols[w.start]) / n,
                self._same_lines(w, docs),
                np.bincount(self.of, minlength=docs) / n**0.75,
                per((w.end - w.start).astype(float)) / n,
                top / n,
                per(_END[w.data[w.end - 1]].astype(float)) / n,
            ],
            axis=1,
        )

    def _same_lines(self, w: Words, docs: int) -> np.ndarray:
        """Share of a text's lines with words that equal an earlier one, word by word."""
        if not len(w.hash):
            return np.zeros(docs)
        newline = np.append(0, np.cumsum(w.data == 10))
        line = newline[w.start]
        head = np.flatnonzero(np.append(True, (line[1:] != line[:-1]) | (self.doc[1:] != self.doc[:-1])))
        hashes = ranges(prefix(w.hash, 3), head, np.append(head[1:], len(w.hash)), 3)
        of = self.doc[head]
        order = np.lexsort((hashes, of))
        same = (hashes[order][1:] == hashes[order][:-1]) & (of[order][1:] == of[order][:-1])
        return np.bincount(of[order][1:][same], minlength=docs) / np.maximum(1, np.bincount(of, minlength=docs))

    def votes(self) -> list[str]:
        """Each labeller's vote on each text: 1 good, 0 bad, 2 none.  The labellers overlap and none sees a label."""
        n, symbols, same, variety, letters, top, ends = self.all.T
        vote = lambda bad, good: np.where(bad, 0, np.where(good, 1, 2))
        table = np.stack(
            [
                vote(n < 20, n >= 60),
                vote(symbols > 0.1, symbols < 0.02),
                vote(same > 0.3, same == 0),
                vote(variety < 0.5, variety > 1.0),
                vote((letters < 2.5) | (letters > 15), (letters >= 3) & (letters <= 11)),
                vote(top > 0.3, top < 0.15),
                vote(ends == 0, ends >= 0.02),
            ],
            axis=1,
        )
        return ["".join(map(str, row)) for row in table.tolist()]

    def bins(self) -> np.ndarray:
        scaled = self.all * np.array([1.0, *[64.0] * (len(LABELLERS) - 1)])
        return np.minimum(BINS - 1, np.log2(1 + scaled).astype(np.int64)) + BINS * np.arange(len(LABELLERS))

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashed feature and value of each distinct word of each text."""
        own = BINS * len(LABELLERS)
        return (mix(self.hash) % U(DIMENSIONS - own)).astype(np.int64) + own, 0.3 * np.sqrt(self.count / np.maximum(1, self.n)[self.of])


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(Measured(part.column(1)).votes(), pa.string())], ["order", "pattern"])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, 0):
            m = Measured(part.column(0))
            at, value = m.features()
            cut = np.cumsum(np.bincount(m.of, minlength=part.num_rows))[:-1]
            ats, values = np.split(at, cut), np.split(value, cut)
            bins = m.bins()
            ats = [np.append(b, a) for b, a in zip(bins, ats, strict=True)]
            values = [np.append(np.ones(len(LABELLERS)), v) for v in values]
            yield pa.RecordBatch.from_arrays([pa.array(m.votes(), pa.string()), pa.array(ats, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], ["pattern", "at", "value"])


def estimate(patterns: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], np.ndarray]:
    """Posterior of good for each vote pattern, and P(vote | class) of each labeller, by expectation-maximisation.

    Labellers are taken as independent given the class.  The start trusts each a little; counts are
    smoothed; the pattern table (3**labellers rows at most) stands for all documents.
    """
    keys = sorted(patterns)
    if not keys:
        return {}, np.full((len(LABELLERS), 2, 3), 1 / 3)
    vote = np.array([[int(c) for c in k] for k in keys])
    weight = np.array([patterns[k] for k in keys], float)
    p = np.zeros((len(LABELLERS), 2, 3))
    p[:, 0], p[:, 1] = (0.5, 0.3, 0.2), (0.05, 0.85, 0.1)
    prior = np.array([1 - PRIOR_GOOD, PRIOR_GOOD])
    for _ in range(rounds):
        log = np.log(prior)[None] + sum(np.log(p[j][:, vote[:, j]]).T for j in range(len(LABELLERS)))
        post = np.exp(log - log.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        mass = post * weight[:, None]
        prior = (mass.sum(axis=0) + 1) / (mass.sum() + 2)
        for j in range(len(LABELLERS)):
            for v in range(3):
                p[j, :, v] = mass[vote[:, j] == v].sum(axis=0) + 1.0
            p[j] /= p[j].sum(axis=1, keepdims=True)
    return dict(zip(keys, post[:, 1].tolist(), strict=True)), p


def train(rows: list[tuple[float, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer by full-batch AdaGrad on posterior labels."""
    w, b = np.zeros(DIMENSIONS), 0.0
    rows = [r for r in rows if len(r[1])]
    if not rows:
        return w, b
    y = np.array([r[0] for r in rows])
    at, value = np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows]).astype(float)
    size = np.array([len(r[1]) for r in rows])
    head, of = np.append(0, np.cumsum(size)[:-1]), np.repeat(np.arange(len(rows)), size)
    # Both classes weigh the same, however rare one is.
    share = np.clip(y.mean(), 0.01, 0.99)
    cost = y / share + (1 - y) / (1 - share)
    cost /= cost.sum()
    g2, gb2 = np.full(DIMENSIONS, 1e-8), 1e-8
    for _ in range(STEPS):
        z = np.add.reduceat(w[at] * value, head) + b
        error = (1 / (1 + np.exp(-z)) - y) * cost
        g = np.bincount(at, weights=error[of] * value, minlength=DIMENSIONS) + 1e-6 * w
        gb = error.sum()
        g2, gb2 = g2 + g * g, gb2 + gb * gb
        w, b = w - 0.5 * g / np.sqrt(g2), b - 0.5 * gb / np.sqrt(gb2)
    return w, float(b)


def _scored(w: np.ndarray, b: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                m = Measured(part.column(1))
                at, value = m.features()
                z = b + w[m.bins()].sum(axis=1) + np.bincount(m.of, weights=w[at] * value, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))], ["doc_id", "score"])

    return run


def quality(docs: DataFrame, at: float = 0.5, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score (posterior of good), keep (score >= at).

    No labels are used.  All documents' votes enter the estimate; the linear scorer is trained on
    TRAIN_DOCS documents at most and scores every whole text.  Null and empty texts have no words, so
    labellers call them bad; equal texts get equal scores; an empty table gives no rows.
    """
    ids = Ids(docs, id_col)
    base = docs.select(ids.encode().alias("doc_id"), text_or_empty(text_col).alias("text"))
    voted = materialize(base.select(F.xxhash64("text").alias("order"), "text").mapInArrow(_voted, "order long, pattern string"), "quality-votes")
    posterior, _ = estimate({r[0]: r[1] for r in voted.groupBy("pattern").count().collect()})
    # The hash below which TRAIN_DOCS documents lie; equal texts are one.
    limit = voted.select("order").distinct().orderBy("order").limit(TRAIN_DOCS).agg(F.max("order")).first()[0]
    rows = []
    if limit is not None:
        sample = base.select("text").where(F.xxhash64("text") <= F.lit(limit)).dropDuplicates(["text"]).mapInArrow(_featured, "pattern string, at array<int>, value array<float>")
        rows = [(posterior[r[0]], np.array(r[1], np.int64), np.array(r[2])) for r in sample.toLocalIterator()]
    w, b = train(rows)
    scores = base.mapInArrow(_scored(w, b), f"doc_id {ids.type}, score double")
    return scores.select(ids.decode("doc_id").alias("doc_id"), "score", (F.col("score") >= F.lit(at)).alias("keep"))
