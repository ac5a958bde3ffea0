"""Quality rules as a short-circuit cascade, ordered by sampled rejection per cost."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty, window_hashes, words

#: Rows of the sample from which costs and selectivities are estimated, about; the bound is documented, the rules see all rows.
SAMPLE_ROWS = 2_000
#: Runs of each rule on the cached sample, of which the fastest counts, but for the first.
REPEATS = 3
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A named rule.  ``fails`` takes the features by name, each an expression that is worked out only where a rule uses it, and gives a boolean column."""

    name: str
    fails: Callable[[dict[str, Column]], Column]


def repeated_words(w: str, n: int) -> Column:
    """Words inside n-word windows that occur twice or more in the array ``w``, the first occurrence included.

    Windows are hashed, and only where hashes repeat are they sorted to find which; positions are
    then swept once.  All of it is array functions in the row: no window becomes a row.
    """
    hashes = F.expr(f"IF(size({w}) < {n}, cast(array() AS array<bigint>), slice({window_hashes(w, n)}, 1, size({w}) - {n} + 1))")
    empty = F.array().cast("array<int>")

    def marked(s: Column) -> Column:
        twin = lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])
        return F.filter(F.transform(s, lambda x, k: F.when(twin(x, k), x["i"])), lambda i: i.isNotNull())

    def positions(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), empty).otherwise(F.array_sort(F.flatten(F.transform(F.array(ordered), marked))))

    def covered(p: Column) -> Column:
        step = lambda a, x: F.struct((a["n"] + x + F.lit(n) - F.greatest(a["e"], x)).alias("n"), (x + F.lit(n)).alias("e"))
        return F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(0).alias("e")), step, lambda a: a["n"])

    return F.aggregate(F.transform(F.array(hashes), lambda h: covered(positions(h))), F.lit(0), lambda a, x: a + x).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.aggregate(F.array(lines), F.lit(0), lambda a, x: a + F.size(x) - F.size(F.array_distinct(x))).cast("long")


def features(text: str = "text", w: str = "w") -> dict[str, Column]:
    """Expressions of the features of a non-null text and its words."""
    text = F.col(text)
    return {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, rf"[^{SYMBOLS}]+", "")).cast("long"),
        "n_dup_lines": duplicate_lines(text),
        "n_lines": F.size(F.split(text, "\n")).cast("long"),
        "n_repeat_words": repeated_words(w, 8),
        # The rules' own: nothing but the cascade asks for them.
        "n_distinct": F.size(F.array_distinct(w)).cast("long"),
        "n_letters": F.length(F.regexp_replace(text, r"[^\p{L}]+", "")).cast("long"),
        "longest_word": F.coalesce(F.array_max(F.transform(w, lambda x: F.length(x))), F.lit(0)).cast("long"),
    }


#: Features that the contract asks for of every document; all others are left to the rules.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def default_rules() -> list[Rule]:
    """Rules each far from what clean prose shows."""
    return [
        Rule("word_length", lambda f: (f["word_chars"] < 2 * f["n_words"]) | (f["word_chars"] > 20 * f["n_words"])),
        Rule("symbols", lambda f: 4 * f["n_symbols"] > f["word_chars"]),
        Rule("duplicate_lines", lambda f: 2 * f["n_dup_lines"] > f["n_lines"]),
        Rule("letters", lambda f: 2 * f["n_letters"] < f["word_chars"]),
        Rule("variety", lambda f: 50 * f["n_distinct"] < f["n_words"]),
        Rule("longest_word", lambda f: f["longest_word"] > 1000),
    ]


def order_rules(sample: DataFrame, rules: Sequence[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, rejection, seconds) by rejection per cost, best first, measured on a sample of text and w.

    A text is kept if no rule fails, so the order (and any noise in the timing) changes only how
    much is evaluated, never a verdict.  On an empty sample nothing is rejected and the order stays.
    """
    measured = []
    sample = sample.persist()  # SAMPLE_ROWS rows, about
    sample.count()
    for rule in rules:
        fails, took = F.avg(F.coalesce(rule.fails(features()), F.lit(False)).cast("int")), []
        for _ in range(REPEATS):
            begun = time.perf_counter()
            got = sample.agg(fails).first()[0]
            took.append(time.perf_counter() - begun)
        measured.append((rule, float(got or 0.0), min(took[1:])))  # the first run compiles
    sample.unpersist()
    return sorted(measured, key=lambda x: (-x[1] / max(x[2], 1e-6), x[2]))


def any_failure(rules: Sequence[Rule], values: dict[str, Column]) -> Column:
    """Whether a rule fails: CASE works out no rule, nor any feature that only it uses, after the first that fails."""
    case = None
    for rule in rules:
        case = (F if case is None else case).when(F.coalesce(rule.fails(values), F.lit(False)), F.lit(True))
    return F.lit(False) if case is None else case.otherwise(F.lit(False))


def judged(docs: DataFrame, rules: Sequence[Rule] | None = None, *, id_col: str = "doc_id", text_col: str = "text", keep_row: bool = False) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept.

    Counts are those of the whole text.  base_failed: fewer than 20 words, or more than 30 % of
    words in repeated 8-word windows.  kept: not base_failed and no rule of the cascade fails.
    Null and empty texts have no words, so they fail the base; repeated rows are judged each; a rule
    that gives null doesn't fail; an empty table gives no rows.
    """
    rules = default_rules() if rules is None else list(rules)
    text = text_or_empty(text_col)
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_row else []
    total = docs.count()
    sample = materialize(docs.sample(min(1.0, SAMPLE_ROWS / max(total, 1)), seed=11).select(text.alias("text"), words(text).alias("w")), "rule-sample")
    ordered = [r for r, _, _ in order_rules(sample, rules)]
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), words(text).alias("w"), *row)
    own = features()
    counted = base.select("doc_id", "text", "w", *own_row(keep_row), *[own[k].alias(k) for k in BASE])
    values = features() | {k: F.col(k) for k in BASE}
    failed = base_fails(values)
    # Documents that the base rejects, and those that an earlier rule does, cost no later rule.
    kept_ = F.when(failed, F.lit(False)).otherwise(~any_failure(ordered, values))
    return counted.select("doc_id", *BASE, failed.alias("base_failed"), *own_row(keep_row), kept_.alias("kept"))


def own_row(keep_row: bool) -> list[str]:
    return ["row"] if keep_row else []


def base_fails(f: dict[str, Column]) -> Column:
    return (f["n_words"] < 20) | (100 * f["n_repeat_words"] > 30 * f["n_words"])


def kept(docs: DataFrame, rules: Sequence[Rule] | None = None, **names) -> DataFrame:
    """The rows of ``docs`` that the base and the cascade keep; null and empty texts go, repeated rows stay or go alike, an empty table stays empty."""
    return judged(docs, rules, keep_row=True, **names).where("kept").select("row.*")
