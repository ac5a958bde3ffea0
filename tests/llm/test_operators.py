"""Operators against brute force on small tables with nulls, empties, long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspan.llm import cascade, components, decontaminate, jaccard, mixing, sharding, substring_dedup, suffix_dedup, toxicity, urlrules, weak_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, sig string, row string, w string"


def texts():
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage, base = prose(70), prose(120)
    out = [None, "", " \n\t ", "One two", "one TWO", "a b c d e f g h i j", "spam " * 300, "spam " * 130, "é ü ñ " * 40]
    out += [base, base, base.replace(" ", "\n", 3), base + " tail", " ".join(base.split()[:-2]), base.upper()]
    out += [f"{prose(30)} {passage} {prose(20 + i)}" for i in range(6)] + [passage, f"{prose(5)}\x0b{passage}"]
    out += [prose(n) for n in (49, 50, 51, 400)] + [prose(6000)]
    for _ in range(30):
        words = base.split()
        for _ in range(rnd.randint(1, 6)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", ["b", None, "a", "c"][i % 4], 1, "x", "y", "z", "q") for i, t in enumerate(texts())]
    rows += [(None, texts()[9], None, None, None, None, None, None, None), rows[9], rows[9]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def removed(rows, n=50):
    first = {}
    key = lambda d: 2**63 - 1 if d is None else d
    for d, t in rows:
        w = WORD.findall(t or "")
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            first[k] = min(first.get(k, key(d)), key(d))
    out = []
    for d, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < key(d):
                gone[i : i + n] = [True] * n
        out.append((d, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("op", [substring_dedup.dedup_substrings, suffix_dedup.dedup_suffixes])
def test_repeats(docs, empty, op):
    assert sorted(map(tuple, op(docs).collect()), key=str) == removed(pairs(docs))
    assert op(empty).count() == 0


def grouped(rows, k, percent):
    sets, ids = [], []
    for d, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
        ids.append(d)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(lambda: 2**63 - 1)
    for i, d in enumerate(ids):
        least[root(i)] = min(least[root(i)], 2**63 - 1 if d is None else d)
    return sorted(((d, len(s), least[root(i)] if least[root(i)] < 2**63 - 1 else None) for i, (d, s) in enumerate(zip(ids, sets, strict=True))), key=str)


@pytest.mark.parametrize("k,percent,block", [(3, 90, 512), (5, 80, 4), (2, 60, 512)])
def test_jaccard(docs, empty, monkeypatch, k, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    got = jaccard.classes(docs, k, percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == grouped(pairs(docs), k, percent)
    assert jaccard.classes(empty).count() == 0


def test_sparse_groups_lose_no_link(spark):
    """Sets of every small size, where groups stay empty often, with one shingle changed or added."""
    rnd = random.Random(8)
    rows = []
    for n in list(range(1, 26)) * 3:
        words = [f"v{rnd.randrange(10**6)}" for _ in range(n + 1)]
        other = words[:]
        other[rnd.randrange(len(other))] = "changed"
        rows += [" ".join(words), " ".join(other), " ".join([*words, "tail"])]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for percent in (60, 80):
        got = jaccard.classes(df, 2, percent).select("doc_id", "n_shingles", "component_id").collect()
        assert sorted(map(tuple, got), key=str) == grouped(pairs(df), 2, percent)
    with pytest.raises(ValueError):
        jaccard.classes(df, 2, 50)


def test_dense_tasks_are_verified_together(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard, "SPARSE", 0)
    got = jaccard.classes(docs, 3, 80).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == grouped(pairs(docs), 3, 80)


def test_sparse_and_dense_tasks_in_one_batch():
    import pyarrow as pa

    counts = np.full(20, 3, np.uint8).tobytes()
    schema = pa.schema([pa.field(n, t, nullable=False) for n, t in (("least", pa.list_(pa.int64())), ("cell", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("block", pa.int32()), ("key", pa.int64()), ("component", pa.int64()), ("n", pa.int64()), ("counts", pa.binary()))])
    rows = [([1], 1, 0, 0, 0, k, k, 60, counts) for k in (1, 2)] + [([2, 5], 2, 0, 0, 0, k, k, 60, counts) for k in range(10, 20)]
    rows += [([1, 3], 3, 0, 0, 0, k, k, 60, counts) for k in (1, 2)] + [([3, 4], 3, 0, 0, 0, 7, 7, 60, counts)]
    batch = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    out = list(jaccard._survivors(80, 1)(iter([batch])))
    assert len({b.schema for b in out}) == 1
    assert [(r["key"], r["other"]) for b in out for r in b.to_pylist() if r["other"] is not None] == [(2, 1), (7, 1), (7, 2)]
    assert sorted(r["key"] for b in out for r in b.to_pylist() if r["other"] is None) == list(range(10, 20))


def test_packed_cells_are_deleted_once_they_have_met(spark, docs, monkeypatch):
    """The largest table doesn't lie on disk beside the texts and their shuffles."""
    held, made, left = jaccard.materialize, {}, {}

    def kept(df, name, *by):
        made[name] = held(df, name, *by)
        if name in ("jaccard-across", "jaccard-cells"):
            left[name] = spark.read.schema(made["jaccard-gathered"].schema).parquet(made["jaccard-gathered"]._scratch_path).where("blobs IS NOT NULL").count()
        return made[name]

    monkeypatch.setattr(jaccard, "materialize", kept)
    got = jaccard.classes(docs, 5, 80).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == grouped(pairs(docs), 5, 80)
    assert left["jaccard-across"] > 0 and left["jaccard-cells"] == 0


def test_one_of_each(spark, docs):
    df = docs.withColumnRenamed("w", "kept_id").withColumnRenamed("row", "its_id")
    least = defaultdict(set)
    for d, _, c in grouped(pairs(df), 5, 80):
        least[d].add(d == c)
    got = jaccard.one_of_each(df, 5, 80)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted((d for d, _ in pairs(df) if True in least[d]), key=str)


def thue_morse(x, y):
    for _ in range(10):
        x, y = x + y, y + x
    return x


def test_words_alike_to_weak_hashes(spark):
    a, b = thue_morse("a", "b"), thue_morse("b", "a")
    prose = " ".join(f"p{i}" for i in range(60))
    df = spark.createDataFrame([(1, f"{prose} {a}"), (2, f"{prose} {b}"), (3, f"{a} x y"), (4, f"{b} x y")], "doc_id long, text string")
    assert sorted(map(tuple, substring_dedup.dedup_substrings(df).collect()), key=str) == removed(pairs(df))
    assert sorted(map(tuple, suffix_dedup.dedup_suffixes(df).collect()), key=str) == removed(pairs(df))
    got = jaccard.classes(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == grouped(pairs(df), 3, 90)
    words = " ".join(thue_morse("u ", "v ").split()), " ".join(thue_morse("v ", "u ").split())
    df = spark.createDataFrame([(1, words[0]), (2, words[1])], "doc_id long, text string")
    assert sorted(map(tuple, suffix_dedup.dedup_suffixes(df).collect()), key=str) == removed(pairs(df))


def test_copies_are_settled_whole(spark, monkeypatch):
    """Of documents that copy each other only the first is compared by its parts; near copies and repeated rows are."""
    from wellspan.llm import windows

    rng, kept = random.Random(5), {}
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(200)]
    near = [" ".join(base[:k] + ["odd"] + base[k + 1 :]) for k in (20, 90, 150)]
    rows = [(i, " ".join(base)) for i in range(1, 40)] + [(50 + i, t) for i, t in enumerate(near * 3)] + [(7, " ".join(base)), (70, near[0]), (70, near[1]), (None, near[2]), (90, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = windows.materialize
    monkeypatch.setattr(windows, "materialize", lambda d, name: kept.setdefault(name, held(d, name)))
    for op in (substring_dedup.dedup_substrings, suffix_dedup.dedup_suffixes):
        kept.clear()
        assert sorted(map(tuple, op(df).collect()), key=str) == removed(pairs(df))
        compared = kept.get("window-compared", kept["window-mixed"]).select("doc", "txt").distinct().count()
        assert compared == 4  # one of each text


def test_repeats_inside_texts_are_one_row(spark, monkeypatch):
    """A line repeated over and over is one row a document, whether all documents go on alike (one content a signature) or one does not."""
    from wellspan.llm import windows

    rng, kept = random.Random(6), {}
    words = [f"w{i}" for i in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    line, odd = " ".join(f"l{i}" for i in range(12)), " ".join(f"l{i}" for i in range(12) if i != 5)
    rows = [(i, f"{prose(20)} {' '.join([line] * rng.randint(60, 70))} {prose(20)}") for i in range(20)]
    rows += [(30, " ".join([line] * 4 + [odd] + [line] * 4 + [odd])), (31, " ".join([line] * 6)), (None, rows[3][1]), (3, rows[3][1]), (32, "")]
    held = windows.materialize
    monkeypatch.setattr(windows, "materialize", lambda d, name: kept.setdefault(name, held(d, name)))
    for op in (substring_dedup.dedup_substrings, suffix_dedup.dedup_suffixes):
        for some in (rows, rows[:20]):
            kept.clear()
            df = spark.createDataFrame(some, "doc_id long, text string")
            assert sorted(map(tuple, op(df).collect()), key=str) == removed(pairs(df))
            assert kept["window-instances"].count() < 25 * len(some)  # 60 lines or more, each of one instance at least


def test_string_ids(spark, docs):
    text = {f"d{d:03}": t for d, t in pairs(docs) if d is not None}
    df = spark.createDataFrame([*text.items(), (None, texts()[9])], "doc_id string, text string")
    rows = sorted(text.items())
    number = {d: i for i, (d, _) in enumerate(rows)} | {None: None}
    want = removed([(number[d], t) for d, t in [*rows, (None, texts()[9])]])
    for op in (substring_dedup.dedup_substrings, suffix_dedup.dedup_suffixes):
        assert sorted(((number[r[0]], *r[1:]) for r in op(df).collect()), key=str) == want
    got = [(number[r[0]], r[1], number[r[2]]) for r in jaccard.classes(df).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=str) == grouped([(number[d], t) for d, t in [*rows, (None, texts()[9])]], 3, 90)
    assert {r["doc_id"] for r in weak_quality.quality(df).collect()} == set(text) | {None}


def test_kept_text(docs):
    rows = substring_dedup.dedup_substrings(docs, with_text=True).collect()
    assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in rows)


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7)]
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for start in sorted(near):
        stack = [start] if start not in want else []
        while stack:
            if (x := stack.pop()) not in want:
                want[x] = start
                stack += near[x]
    got = {r[0]: r[1] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in want.items() if near[k] - {k}}


def test_mixing_with_many_sources(docs, monkeypatch):
    want = sorted(map(tuple, mixing.mixed(docs).collect()), key=str)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, mixing.mixed(docs).collect()), key=str) == want


def test_mixing(docs, empty):
    rows = mixing.mixed(docs).collect()
    assert len(rows) == docs.count() and all(r["taken"] in (r["size"] * r["copies"],) and r["copies"] <= 2 for r in rows)
    target = {(r["source_size"], r["target"]) for r in rows}
    assert sum(t for _, t in target) == pytest.approx(1.5 * sum(s for s, _ in target))
    assert all(t <= 2 * s + 1e-6 for s, t in target)
    assert mixing.mix(docs).count() == sum(r["copies"] for r in rows) and mixing.mix(docs).columns == docs.columns
    assert mixing.mixed(empty).count() == 0


def test_sharding(docs, empty):
    rows = sharding.place(docs, 7).collect()
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    text = {d: t for d, t in pairs(docs)}
    assert all(r["text_crc32"] == zlib.crc32((text[r["doc_id"]] or "").encode()) for r in rows)
    assert all(sharding.row_at(len(rows), r["shard"], r["slot"], 7) == r["row_number"] for r in rows)
    assert sharding.place(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000])
def test_feistel(n):
    f = sharding.Feistel(n)
    out = f.permute(np.arange(n))
    assert sorted(out.tolist()) == list(range(n)) and f.invert(out).tolist() == list(range(n))


@pytest.mark.parametrize("bound,block", [(200_000, 1), (0, 2_000_000), (0, 20)])
def test_decontaminate(spark, docs, empty, monkeypatch, bound, block):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", bound)
    monkeypatch.setattr(decontaminate, "BLOCK_HASHES", block)
    items = [(1, " ".join(texts()[9].split()[20:60])), (2, "One, two!"), (3, None), (4, ""), (10, texts()[15])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    grams = defaultdict(set)
    for i, t in items:
        w = low(t)
        for at in range(len(w) - min(10, len(w)) + 1 if w else 0):
            grams[tuple(w[at : at + 10])].add(str(i))
    want = []
    for d, t in pairs(docs):
        w, hit, found = low(t), set(), set()
        for g, ids in grams.items():
            for at in range(len(w) - len(g) + 1):
                if tuple(w[at : at + len(g)]) == g:
                    hit |= set(range(at, at + len(g)))
                    found |= ids
        want.append((d, len(w), len(hit), sorted(found)))
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.scan(docs, bench).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert decontaminate.decontaminate(docs, bench).count() == sum(not w[2] for w in want)
    cut = decontaminate.decontaminate(docs, bench, remove="spans")
    assert sorted(len(low(t)) for _, t in pairs(cut)) == sorted(w[1] - w[2] for w in want) and cut.columns == docs.columns
    assert decontaminate.scan(empty, bench).count() == 0 and decontaminate.scan(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_quality_rules(docs, empty):
    want = []
    for d, t in pairs(docs):
        t = t or ""
        w = WORD.findall(t)
        grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        again = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want.append((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), len(w) < 20 or 100 * len(again) > 30 * len(w)))
    got = cascade.judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert cascade.judged(empty).count() == 0


def test_large_benchmark(spark):
    """More windows than stand in the plan; no window of the documents is shuffled."""
    vocabulary = [f"b{i}" for i in range(400)]
    rnd = random.Random(4)
    bench = spark.createDataFrame([(i, " ".join(rnd.choices(vocabulary, k=3010))) for i in range(100)], "item_id long, text string")
    some = bench.where("item_id < 3").collect()
    docs = [(r["item_id"], "x " + " ".join(r["text"].split()[5 : 15 + r["item_id"]]) + " y") for r in some] + [(9, " ".join(vocabulary[:300]))]
    got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontaminate.scan(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {0: (10, ["0"]), 1: (11, ["1"]), 2: (12, ["2"]), 9: (0, [])}


def test_cascade_keeps_and_orders(spark, docs):
    prose = [(5000 + i, " ".join(f"good{chr(97 + j % 26)} word{chr(97 + i + j % 20)}s" for j in range(40)), *[None] * 7) for i in range(5)]
    docs = docs.union(spark.createDataFrame(prose, SCHEMA))
    rows = {r["doc_id"]: r for r in cascade.judged(docs).collect()}
    kept = cascade.kept(docs).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter(r["doc_id"] for r in cascade.judged(docs).collect() if r["kept"]) and len(kept)
    assert cascade.kept(docs).columns == docs.columns
    rules = cascade.default_rules()
    other = {r["doc_id"]: r["kept"] for r in cascade.judged(docs, rules[::-1]).collect()}
    assert all(rows[d]["kept"] == k for d, k in other.items() if d is not None)
    junk = [(1, " ".join(["a1"] * 5 + [f"{i}" * 5 for i in range(100)])), (2, " ".join(f"w{i}" for i in range(100)) + " " + "x" * 1001), (3, " ".join(f"good{i} words" for i in range(100)))]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in cascade.judged(spark.createDataFrame(junk, "doc_id long, text string")).collect()}
    assert got == {1: (False, False), 2: (False, False), 3: (False, True)}


def edits(a, b):
    """Edits from ``a`` to each beginning of ``b``, by trying all; a swap of two neighbours is one edit."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a):
        row = [i + 1]
        for j, y in enumerate(b):
            row.append(min(rows[-1][j + 1] + 1, row[j] + 1, rows[-1][j] + (x != y)))
            if i and j and x == b[j - 1] and y == a[i - 1]:
                row[-1] = min(row[-1], rows[-2][j - 1] + 1)
        rows.append(row)
    return rows[-1]


def plain_score(model, text):
    """The score by trying every term on every word, without a trie, an automaton or a cache."""
    low, weights = (text or "").lower(), {}
    quoted = toxicity.quotations(low)
    tokens = [(m.group(), m.start()) for m in re.finditer(r"\w+", low)]
    for i, (word, at) in enumerate(tokens):
        near = {w for w, _ in tokens[max(0, i - toxicity.CONTEXT) : i + toxicity.CONTEXT + 1]}
        weight = toxicity.QUOTED if near & toxicity.REPORTING or any(a < at < b for a, b in quoted) else 1.0
        for term in model.exact:
            body = term.removesuffix("$")
            row = edits(body, word)
            d = row[-1] if term.endswith("$") else min(row)
            if d == 0 or d == 1 and len(body) >= toxicity.FUZZY_FROM:
                weights[term, d] = max(weight, weights.get((term, d), 0))
    clean = 1 - model.base
    for (term, d), weight in sorted(weights.items()):
        clean *= 1 - weight * (model.fuzzy if d else model.exact).get(term, 0.0)
    return 1 - clean


def test_scores_against_every_term_on_every_word(spark, docs):
    model = toxicity.Model(exact={"idiot$": 0.9, "loser": 0.7, "scum$": 0.8, "w12$": 0.6}, fuzzy={"idiot$": 0.5, "loser": 0.4}, base=0.03)
    given = [t for _, t in pairs(docs)] + ["you Idiot!", "an idoit, an idiiot and a losers' club", 'he said "scum" twice', "scun", "lose it, looser", None, "“idiot” idiots"]
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.scored(df, model).collect()}
    for i, text in enumerate(given):
        assert got[i] == pytest.approx(plain_score(model, text), abs=1e-12), text


def test_expectation_maximisation_by_hand():
    """One round of the estimate written out, labeller by labeller."""
    patterns = {"1111111": 40, "1121111": 20, "0000000": 10, "0200002": 5, "1101111": 8}
    post, p = weak_quality.estimate(patterns, rounds=1)
    start = {0: (0.5, 0.3, 0.2), 1: (0.05, 0.85, 0.1)}
    for pattern in patterns:
        like = [prior * np.prod([start[c][int(v)] for v in pattern]) for c, prior in ((0, 1 - weak_quality.PRIOR_GOOD), (1, weak_quality.PRIOR_GOOD))]
        assert post[pattern] == pytest.approx(like[1] / sum(like))
    mass = {c: {v: 1.0 + sum(n * (post[k] if c else 1 - post[k]) for k, n in patterns.items() if k[0] == str(v)) for v in range(3)} for c in (0, 1)}
    for c in (0, 1):
        for v in range(3):
            assert p[0, c, v] == pytest.approx(mass[c][v] / sum(mass[c].values()))


def test_quality_against_labels(spark):
    """Held against labels that the classifier never sees: the share of good and bad pairs in the right order."""
    sf = "/root/testdata/sf0.01"
    scores = weak_quality.quality(spark.read.parquet(f"{sf}/documents.parquet"))
    rows = scores.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("score", "quality").collect()
    good, bad = (np.array([r["score"] for r in rows if r["quality"] == q]) for q in (1, 0))
    assert len(bad) > 10 and (good[:, None] > bad[None]).mean() > 0.85


def test_toxicity(spark, docs, empty):
    rows = [(i, f"some plain words number w{i} here" + (" you idiot" if i % 4 == 0 else "")) for i in range(200)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(train, labels)
    assert model.score("what an idiot he is") > 0.5 and model.score("what an idiiot he is") > 0.5
    assert model.score('she said "idiot" to him') < 0.5 and model.score("plain words") < 0.5 and model.score(None) == model.score("")
    assert toxicity.scored(docs, model).count() == docs.count() and toxicity.scored(empty, model).count() == 0
    assert toxicity.not_toxic(docs, model).columns == docs.columns
    assert toxicity.fit(train, labels.limit(0)).score("idiot") < 0.5


@pytest.mark.parametrize("term", ["idiot$", "lowei"])
def test_automaton(term):
    trie, body = toxicity.Trie([term]), term.removesuffix("$")
    letters = "abdilotwe"

    rnd = random.Random(3)
    for _ in range(3000):
        w = list(body)
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(w) + 1)
            w[at : at + rnd.randint(0, 1)] = rnd.choice(["", rnd.choice(letters)])
            if rnd.random() < 0.3:
                w[at : at + 2] = w[at : at + 2][::-1]
        word = "".join(w)
        if word:
            row = edits(body, word)
            d = row[-1] if term.endswith("$") else min(row)
            assert trie.match(word) == (((term, d),) if d <= 1 else ()), word


def test_quality(docs, empty):
    rows = {r["doc_id"]: r for r in weak_quality.quality(docs).collect()}
    assert len(rows) and all(0 <= r["score"] <= 1 for r in rows.values())
    assert weak_quality.quality(empty).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://EXAMPLE.com/en/1?x", "https://a.example.com/en/7#t", "ftp://b.net/de/8", "http://example.net/de/8/x", "http://com/en", "http://xcom/en/", "http://a.org/es/", "http://h.org/a/1", "http://h.org/a/2"]
    pages = spark.createDataFrame([(i, u, 1 if i >= 10 else None, "x") for i, u in enumerate(urls)], "page_id long, url string, bad int, host string")
    got = {r["page_id"]: r for r in urlrules.judged(pages, F.col("bad")).collect()}
    assert (got[0]["host"], got[0]["path"], got[2]["host"]) == ("", "", "")
    assert [got[i]["rule"] for i in range(3, 10)] == ["com/en/", "example.com/en/7", "net/de/", "example.net/de/8", None, None, "org/es/"]
    assert got[3]["host"] == "example.com" and got[4]["verdict"] == "allow" and got[10]["verdict"] == got[11]["verdict"]
    assert urlrules.judged(pages.limit(0), F.col("bad")).count() == 0
