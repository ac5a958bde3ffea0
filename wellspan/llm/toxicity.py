"""Toxicity: a lexicon trie met by Levenshtein automata, with hits weighed by their context."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, materialize, release, text_or_empty
from .textcols import chunks, tokenize

#: Labelled documents that are learned from at most (those with the least hashed ids).
TRAIN_DOCS = 20_000
#: Hits wanted in each toxic training document before terms stop being added for it.
HITS = 3
#: Lengths of stems (longer tokens are no words, but their beginnings count); a term ending in END is a whole word, another a stem that any ending may follow.
STEM, END = (4, 40), "$"
#: Terms of fewer letters are matched only as they are.
FUZZY_FROM = 5
#: Words each side of a hit that are read as its context, and what a hit counts in quotation or report.
CONTEXT, QUOTED = 4, 0.4
#: Fixed words that report what others say.
REPORTING = frozenset("said says wrote called quote quoted quoting reported sagte schrieb nannte zitat dit écrit appelé citation dijo escribió llamó cita".split())
WORD = re.compile(r"\w+")
#: ASCII but letters, digits and the underscore separates tokens.
NOT_WORD = np.array([i < 128 and not (chr(i).isalnum() or i == 95) for i in range(256)])
#: Words whose matches a task remembers.
CACHE = 600_000
#: Quotation marks, and what may stand between a mark and the start of its paragraph.
MARKS, BREAK = re.compile('"+|[“”«»„]'), re.compile(r"\n[^\S\n]*\n\s*")
#: Opening mark of each closing one; ``“`` closes ``„`` where one is open, and opens otherwise.
OPENING = {"”": "“", "»": "«"}


def quotations(text: str) -> list[tuple[int, int]]:
    """(first mark, last mark) of the quotations of a text, outermost only, in order; one pass, any length.

    Marks of each kind are paired by themselves, inner pairs first; straight marks side by side are one.
    A straight mark closes what is open unless it stands before a word and after white space: then the
    open one has no partner.  With none open it opens, unless it ends a word (``5" wide``).  A mark that
    opens at the start of a paragraph while its kind is open goes on with that quotation.  A mark without
    a partner quotes nothing.
    """
    open_at: dict[str, list[int]] = {'"': [], "“": [], "«": [], "„": []}
    pairs = []
    starts = {0} | {m.end() for m in BREAK.finditer(text)}
    for m in MARKS.finditer(text):
        mark, at = m.group()[0], m.start()
        before, after = text[at - 1 : at] if at else "", text[m.end() : m.end() + 1]
        kind, closes = OPENING.get(mark, mark), mark in OPENING
        if mark == '"':
            begins = after.strip() and not before.strip()
            ends = before.strip() and not _letter(after) and (not after.strip() or _letter(before))
            closes = bool(not begins if open_at[kind] else ends)
        elif mark == "“" and open_at["„"]:
            kind, closes = "„", True
        waiting = open_at[kind]
        if closes:
            if waiting:
                pairs.append((waiting.pop(), at))
        elif not (waiting and at in starts):
            if mark == '"':
                waiting.clear()
            waiting.append(at)
    out: list[tuple[int, int]] = []
    for a, b in sorted(pairs):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _letter(character: str) -> bool:
    return character.isalnum() or character == "_"


class Trie:
    """Terms letter by letter; ``match`` runs a word's Levenshtein automaton of distance 1 along it.

    A swap of two neighbouring letters is one edit, as a letter more, less or another is.
    """

    def __init__(self, terms: Iterable[str]):
        self.root: dict = {}
        self.heads: set[str] = set()
        self.tails: set[str] = set()
        cuts: set[int] = set()
        places: set[tuple[int, int]] = set()
        for term in sorted(set(terms)):
            body = term.removesuffix(END)
            node = self.root
            for letter in body:
                node = node.setdefault(letter, {})
            node.setdefault(END, []).append(term)
            half = len(body) // 2
            self.heads.add(body[:half])
            self.tails.add(body[half:])
            cuts.add(half)
            places |= {(at, at + len(body) - half) for at in (half - 1, half, half + 1) if at >= 0}
        self.cuts, self.places = sorted(cuts), sorted(places)

    def plausible(self, word: str) -> bool:
        """One edit leaves one half of a term whole, the head in its place or the tail at most one letter off, or swaps the letters where they meet."""
        for n in self.cuts:
            if word[:n] in self.heads or 0 < n < len(word) and word[: n - 1] + word[n] in self.heads:
                return True
        for i, j in self.places:
            if word[i:j] in self.tails:
                return True
        return False

    def match(self, word: str) -> tuple[tuple[str, int], ...]:
        """(term, distance) of all terms within distance 1 of the word, stems of its beginning."""
        out: dict[str, int] = {}
        if self.root and self.plausible(word):
            self._walk(self.root, word, tuple(range(len(word) + 1)), (), "", 0, out)
        return tuple(sorted(out.items()))

    def _walk(self, node: dict, word: str, row: tuple[int, ...], above: tuple[int, ...], last: str, depth: int, out: dict[str, int]) -> None:
        for letter, below in node.items():
            if letter == END:
                for term in below:
                    distance = row[-1] if term.endswith(END) else min(row)
                    if distance == 0 or distance == 1 and depth >= FUZZY_FROM:
                        out[term] = min(distance, out.get(term, 9))
                continue
            lo, hi = max(0, depth - 1), min(len(word), depth + 3)
            new = [9] * (len(word) + 1)
            if depth + 1 <= 1 or lo == 0:
                new[0] = depth + 1
            for i in range(max(1, lo), hi + 1):
                new[i] = min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (word[i - 1] != letter))
                if i > 1 and above and word[i - 2] == letter and word[i - 1] == last:
                    new[i] = min(new[i], above[i - 2] + 1)
            if min(new) <= 1:
                self._walk(below, word, tuple(new), row, letter, depth + 1, out)


@dataclass
class Model:
    """Terms with the learned probability that a document with a hit is toxic, exact and at distance 1."""

    exact: dict[str, float] = field(default_factory=dict)
    fuzzy: dict[str, float] = field(default_factory=dict)
    base: float = 0.05
    _trie: Trie | None = field(default=None, repr=False)
    _known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64), repr=False)
    _hot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64), repr=False)
    _hits: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"exact": self.exact, "fuzzy": self.fuzzy, "base": self.base, "_trie": None, "_known": np.zeros(0, np.uint64), "_hot": np.zeros(0, np.uint64), "_hits": {}}

    def hits(self, word: str) -> tuple[tuple[str, int], ...]:
        """What the word hits; remembered, up to a bound."""
        if self._trie is None:
            self._trie = Trie(self.exact)
        if word not in self._hits:
            if len(self._hits) > CACHE:
                self._hits.clear()
            self._hits[word] = self._trie.match(word)
        return self._hits[word]

    def suspects(self, texts: pa.Array) -> np.ndarray:
        """Which texts have a token with a hit.  Tokens are told apart by hash; each new one is matched once."""
        if self._trie is None:
            self._trie = Trie(self.exact)
        w = tokenize(texts, NOT_WORD, lower=True)
        distinct, first = np.unique(w.hash, return_index=True)
        new = ~_among(distinct, self._known)
        hot = []
        for h, i in zip(distinct[new].tolist(), first[new].tolist(), strict=True):
            token = w.data[w.start[i] : w.end[i]].tobytes().decode("utf-8", "replace").lower()
            if any(self._trie.match(x) for x in ((token,) if token.isalnum() else WORD.findall(token))):
                hot.append(h)
        if len(self._known) > CACHE:
            self._known = np.zeros(0, np.uint64)
        self._known = np.union1d(self._known, distinct[new])
        self._hot = np.union1d(self._hot, np.array(hot, np.uint64))
        out = np.zeros(len(texts), bool)
        out[np.searchsorted(w.at, np.flatnonzero(_among(w.hash, self._hot)), side="right") - 1] = True
        return out

    def found(self, text: str) -> dict[tuple[str, int], float]:
        """(term, distance) -> weight of its context: 1, or QUOTED if every occurrence is quoted or reported."""
        low = text.lower()
        hit = {w: h for w in set(WORD.findall(low)) if (h := self.hits(w))}
        if not hit:
            return {}
        quoted = quotations(low)
        openings = [a for a, _ in quoted]
        tokens = [(m.group(), m.start()) for m in WORD.finditer(low)]
        out: dict[tuple[str, int], float] = {}
        for i, (word, at) in enumerate(tokens):
            if word in hit:
                near = {w for w, _ in tokens[max(0, i - CONTEXT) : i + CONTEXT + 1]}
                k = bisect_left(openings, at)
                inside = k > 0 and at < quoted[k - 1][1]
                weight = QUOTED if inside or near & REPORTING else 1.0
                for key in hit[word]:
                    out[key] = max(out.get(key, 0.0), weight)
        return out

    def score(self, text: str | None) -> float:
        """Probability that at least one hit is meant; without hits the base rate of documents without hits."""
        clean = 1.0 - self.base
        for (term, distance), weight in sorted(self.found(text or "").items()):
            clean *= 1.0 - weight * (self.fuzzy if distance else self.exact).get(term, 0.0)
        return 1.0 - clean


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _terms_in(terms: Sequence[str]):
    wanted = frozenset(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                words = set(WORD.findall(text.lower()))
                out.append(sorted({t for w in words for t in (w + END, *(w[:n] for n in range(STEM[0], min(STEM[1], len(w)) + 1))) if t in wanted}))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string()))], ["terms"])

    return run


def _hits_in(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: Counter = Counter()
            suspect = np.concatenate([model.suspects(part.column(0)) for part in chunks(batch, 0)]) if batch.num_rows else []
            for text, toxic, look in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), suspect, strict=True):
                found = model.found(text) if look else {}
                exact = any(d == 0 for _, d in found)
                for term, distance in found or {("", 0): 1.0}:
                    if not (distance and exact):  # what an exact hit explains says nothing of others
                        sums[term, distance, toxic] += 1
            keys = sorted(sums)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.int32()), pa.array([sums[k] for k in keys], pa.int64())], ["term", "distance", "toxic", "docs"])

    return run


def cover(candidates: dict[str, int], docs: list[list[str]], least: int) -> list[str]:
    """Terms, greedily, until each document has HITS of them or no term helps ``least`` documents more.

    Of terms that help equally many the longest is taken, so a stem is as long as its family allows.
    """
    missing = [HITS] * len(docs)
    where: dict[str, set[int]] = {}
    for i, terms in enumerate(docs):
        for t in terms:
            if t in candidates:
                where.setdefault(t, set()).add(i)
    taken: list[str] = []
    while where:
        gain = {t: sum(missing[i] > 0 for i in at) for t, at in where.items()}
        best = max(gain, key=lambda t: (gain[t], len(t), t))
        if gain[best] < least:
            break
        for i in where.pop(best):
            missing[i] -= 1
        taken.append(best)
        # Longer and shorter forms of a taken term are the same evidence.
        body = best.removesuffix(END)
        where = {t: at for t, at in where.items() if gain[t] >= least and not (t.removesuffix(END).startswith(body) or body.startswith(t.removesuffix(END)))}
    return taken


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn the lexicon and its weights from the labelled documents given, TRAIN_DOCS of them at most.

    Of several labels for an id the largest counts; null ids and labels are left out.  Without toxic
    labels the lexicon is empty and every score is the base rate.
    """
    per_doc = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("its_id")).agg(F.max(label_col).cast("int").alias("toxic"))
    chosen = materialize(per_doc.orderBy(F.xxhash64("its_id"), "its_id").limit(TRAIN_DOCS), "toxic-labels")  # at most TRAIN_DOCS short rows
    train = materialize(docs.select(F.col(id_col).alias("its_id"), text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), "its_id").select("text", "toxic"), "toxic-train")
    sizes = {r[0]: r[1] for r in train.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return Model(base=min(0.45, 1.0 / (clean + 2.0)))
    least = max(2, toxic // 200)
    words = train.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{Nd}_]+"), F.lit(0)))).alias("w"))
    counts = words.groupBy("w").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    stems = F.transform(F.sequence(F.lit(STEM[0]), F.greatest(F.lit(STEM[0]), F.least(F.lit(STEM[1]), F.length("w")))), lambda n: F.substring(F.col("w"), F.lit(1), n))
    forms = F.concat(F.array(F.concat("w", F.lit(END))), F.when(F.length("w") >= STEM[0], stems).otherwise(F.array().cast("array<string>")))
    terms = counts.select(F.explode(forms).alias("term"), "t", "c").groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    pure = terms.where((F.col("t") >= least) & (F.col("c") * 50 * max(toxic, 1) <= F.col("t") * max(clean, 1)))
    candidates = {r[0]: r[1] for r in pure.select("term", "t").collect()}  # terms of at most TRAIN_DOCS texts, few of which are pure
    incidence = train.where("toxic = 1").select("text").mapInArrow(lean(_terms_in(sorted(candidates))), "terms array<string>").collect()  # at most TRAIN_DOCS lists
    model = Model(exact=dict.fromkeys(cover(candidates, [list(r[0]) for r in incidence], least), 0.5))
    seen: Counter = Counter()
    for term, distance, label, n in train.mapInArrow(lean(_hits_in(model)), "term string, distance int, toxic int, docs long").groupBy("term", "distance", "toxic").agg(F.sum("docs")).collect():
        seen[term, distance, label] += n
    for term in model.exact:
        model.fuzzy[term] = (seen[term, 1, 1] + 1.2) / (seen[term, 1, 1] + seen[term, 1, 0] + 2.0)
        model.exact[term] = (seen[term, 0, 1] + 0.8) / (seen[term, 0, 1] + seen[term, 0, 0] + 1.0)
    model.base = min(0.45, (seen["", 0, 1] + 0.5) / (seen["", 0, 1] + seen["", 0, 0] + 1.0))
    return model


def scored(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``toxicity`` in [0, 1] for every whole text, in place of any column of that name.

    Null and empty texts have no hits and get the base rate; equal texts get equal scores; an empty
    table gives no rows.
    """

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = []
        for part in chunks(pa.RecordBatch.from_arrays([texts], ["text"]), 0):
            column = part.column(0)
            scores = np.full(len(column), model.score(""))
            for i in np.flatnonzero(model.suspects(column)).tolist():
                scores[i] = model.score(column[i].as_py())
            out.append(scores)
        release()
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn("toxicity", score(text_or_empty(text_col)))


def not_toxic(docs: DataFrame, model: Model, at: float = 0.5, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose toxicity is below ``at``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = scored(docs.select(row.alias("row"), F.col(text_col).alias("text")), model)
    return rows.where(F.col("toxicity") < at).select("row.*")
