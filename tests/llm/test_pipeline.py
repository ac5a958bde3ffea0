"""Every stage of the corpus pipeline against brute force on the stage's own input, and the chain."""

import random
import zlib
from collections import Counter

import corpus_pipeline
import pytest
from test_operators import grouped, plain_score, texts

from wellspan.llm import toxicity

ITEM = "the quick brown fox jumps over the lazy dog near the old river bank"
LABELS = [(i, int(i % 4 == 0)) for i in range(1000, 1200)]


def documents():
    rnd = random.Random(6)
    rows = [(i, t, "en", ["b", None, "a"][i % 3], 0) for i, t in enumerate(texts())]
    rows += [(None, texts()[9], "en", "a", None), rows[9], rows[9]]
    rows += [(i, f"some plain words number {rnd.random()} here" + (" you idiot" if toxic else ""), "en", "c", 0) for i, toxic in LABELS]
    rows += [(2000, f"start {ITEM.upper()} end", "en", "a", 0), (2001, "the quick brown fox jumps over the lazy dog", "en", "a", 0), (2002, "you idiiot", "de", "a", 0)]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(documents(), schema).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(LABELS, "doc_id long, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def kept_toxic(spark, rows, folder):
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.read.parquet(f"{folder}/labels.parquet"))
    assert model.exact
    return [r for r in rows if plain_score(model, r[1]) < 0.5]


def kept_near(rows):
    first = {}
    for d, _, c in grouped([(r[0], r[1]) for r in rows], 5, 80):
        first[d] = first.get(d, False) or d == c
    return [r for r in rows if first[r[0]]]


def kept_clean(rows):
    import re

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    item = words(ITEM)
    windows = {tuple(item[i : i + 10]) for i in range(len(item) - 9)}
    return [r for r in rows if not any(tuple(words(r[1])[i : i + 10]) in windows for i in range(len(words(r[1])) - 9))]


def test_stages(spark, folder):
    docs, rows = spark.read.parquet(f"{folder}/documents.parquet"), documents()
    order = lambda x: sorted(map(tuple, x), key=str)
    out = []
    for name, stage in corpus_pipeline.STAGES:
        got = [tuple(r) for r in stage(spark, docs, folder).collect()]
        match name:
            case "toxicity":
                assert order(got) == order(kept_toxic(spark, rows, folder)) and 0 < len(got) < len(rows)
            case "near_duplicates":
                assert order(got) == order(kept_near(rows)) and 0 < len(got) < len(rows)
            case "decontamination":
                assert order(got) == order(kept_clean(rows)) and len(got) == len(rows) - 1
            case "mixing":
                had, have = Counter(rows), Counter(got)
                assert set(have) <= set(had) and all(have[r] <= 2 * had[r] for r in had)
                size = lambda r: len((r[1] or "").split())
                assert sum(size(r) for r in got) == pytest.approx(1.5 * sum(size(r) for r in rows), rel=0.25)
            case "sharding":
                counts = Counter(r[3] for r in got)
                assert max(counts.values()) - min(counts.values()) <= 1
                assert all(sorted(r[4] for r in got if r[3] == s) == list(range(n)) for s, n in counts.items())
                size = lambda r: (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()))
                assert order(r[:3] for r in got) == order(map(size, rows))
        out.append(len(got))
        if name != "sharding":
            rows = got
            docs = spark.createDataFrame(got, "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.run(spark, folder).count() == out[-1]


def test_empty(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
