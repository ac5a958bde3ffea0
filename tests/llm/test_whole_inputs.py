"""Whole results where a part was given before."""

import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wellspan.llm import toxicity, urlrules


def test_deep_paths_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(urlrules, "TABLES", 2)
    word = lambda i: chr(97 + i // 26) + chr(97 + i % 26)
    rows = [(f"http://h.org/a/b/c/d/{kind}/{word(i % 30)}/{word(i)}", bad) for kind, bad in (("spam", 1), ("docs", 0)) for i in range(120)]
    rows += [(f"http://h.org/a/b/c/d/e/f/g/h/i/j/{kind}/{i}", bad) for kind, bad in (("x", 1), ("y", 0)) for i in range(60)]
    rows += [("http://h.org/a/b/c/d", 0), ("http://h.org/a", 0), ("http://h.org/", None), ("http://one.org/" + "s/" * 400, None)]
    pages = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    got = {r["page_id"]: r for r in urlrules.judged(pages, F.col("bad"), ()).collect()}
    assert sorted(got) == list(range(len(rows)))
    assert all(got[i]["verdict"] == ("block" if bad else "allow") for i, (_, bad) in enumerate(rows) if bad is not None)
    assert got[len(rows) - 1]["template"] == "/+" * 400


def families(children):
    """{child: label} of a node's labelled children (child, labelled, bad)."""
    out = []
    for child, n, b in sorted(children, key=lambda c: (c[2] / c[1], c[0], c[1], c[2])):
        if out:
            names, m, k = out[-1]
            rate = (k + b) / (m + n)
            if abs(k / m - b / n) <= urlrules.SIGMAS * (rate * (1 - rate) * (1 / m + 1 / n)) ** 0.5:
                out[-1] = [*names, child], m + n, k + b
                continue
        out.append(([child], n, b))
    label = lambda names: "+" if len(out) == 1 else names[0] if len(names) == 1 else "(" + "|".join(sorted(names)) + ")"
    return {c: label(names) for names, _, _ in out for c in names}


def brute(rows):
    """Templates of (host, shape, pages, labelled, bad), node by node."""
    out, nodes = {}, defaultdict(list)
    for r in rows:
        nodes[r[0], ""].append(r)
    for depth in range(9):
        below = defaultdict(list)
        for (host, template), members in nodes.items():
            children = defaultdict(list)
            for r in members:
                children[r[1][depth] if depth < len(r[1]) else ""].append(r)
            pages, many = sum(r[2] for r in members), len(set(children) - {""})
            branch = {c: "*" if many > urlrules.CHILDREN and sum(r[2] for r in its) * urlrules.CHILDREN < pages else c for c, its in children.items() if c}
            sums = defaultdict(lambda: [0, 0])
            for c, name in branch.items():
                for r in children[c]:
                    sums[name][0] += r[3]
                    sums[name][1] += r[4]
            labels = families([(c, n, b) for c, (n, b) in sums.items() if n])
            for child, its in children.items():
                step = f"/{labels.get(branch[child], '+')}" if child else ""
                if len(members) == 1:
                    step = "/+" * (len(members[0][1]) - depth)
                if not child or len(members) == 1:
                    out |= {(host, tuple(r[1])): template + step for r in its}
                else:
                    below[host, template + step] += its
        nodes = below
    return out


def test_bad_template_is_blocked_and_its_twin_is_not(spark):
    """Planted: two branches of one host with the same number of pages, one bad; and words that say nothing beside them."""
    rows = [(f"http://host.org/{kind}/{i % 7}/page{i}", bad) for kind, bad in (("casino", 1), ("manual", 0), ("guide", 0)) for i in range(60)]
    rows += [(f"http://host.org/casino/{i}/unlabelled", None) for i in range(9)] + [(f"http://host.org/manual/{i}/unlabelled", None) for i in range(9)]
    rows += [(f"http://clean.org/{w}/{i}", int(i == 0)) for w in ("a", "b") for i in range(30)]
    pages = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    got = {r["page_id"]: r for r in urlrules.judged(pages, F.col("bad"), ()).collect()}
    for i, (url, _) in enumerate(rows):
        assert got[i]["verdict"] == ("block" if "casino" in url else "allow"), url
    assert {got[i]["template"] for i in range(60, 180)} == {got[60]["template"]} and "guide|manual" in got[60]["template"]


def test_labels_of_pages(spark):
    pages = spark.createDataFrame([("http://h/x/7.html", 1, "p"), ("http://h/8", 2, "q"), (None, 3, "r"), ("http://h/x", 4, "s"), ("http://h/8", 2, "q"), ("http://h/99999999999999999999", 5, "t")], "url string, bad int, n string")
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 1), (None, 0), (9, None)], "doc_id long, quality int")
    got = sorted((r["row"]["n"], r["bad"]) for r in urlrules.page_labels(pages, labels).collect())
    assert got == [("p", 1), ("q", 0), ("q", 0), ("r", None), ("s", None), ("t", None)]
    assert urlrules.page_labels(pages.limit(0), labels).count() == 0 and {r["bad"] for r in urlrules.page_labels(pages, labels.limit(0)).collect()} == {None}


def test_templates_against_brute_force(spark):
    rnd = random.Random(2)
    shapes = {(rnd.choice("gh"), tuple(rnd.choice("abc" if rnd.random() < 0.7 else "defghijklmnopqrstuvwxyz") for _ in range(rnd.randint(0, 7)))) for _ in range(400)}
    rows = []
    for host, shape in sorted(shapes):
        n = rnd.randint(0, 9)
        rows.append((host, list(shape), n + rnd.randint(1, 9), n, round(n * (0.9 if shape[4:5] == ("a",) or shape[1:2] == ("b",) else 0.1))))
    df = spark.createDataFrame(rows, "host string, shape array<string>, pages long, labelled long, bad long")
    want = brute(rows)
    assert len(want) == len(rows) and any(c.isalpha() for t in want.values() for c in t[8:])
    assert {(r["host"], tuple(r["shape"])): r["template"] for r in urlrules.template_tree(df).collect()} == want


LONG = "plain words go on " * 60


@pytest.mark.parametrize(
    "text,weight",
    [
        (f'"{LONG} you idiot {LONG}" he read', 0.4),
        (f"“{LONG} you idiot {LONG}” he read", 0.4),
        (f"„{LONG} you idiot {LONG}“ he read", 0.4),
        (f"«{LONG} you idiot {LONG}» he read", 0.4),
        ('"' + "x" * 500 + '" you idiot "b"', 1.0),
        (f'"{LONG}" you idiot "{LONG}"', 1.0),
        (f'"{LONG}" and "{LONG} you idiot"', 0.4),
        ('a 5" pipe, you idiot, and a 6" pipe', 1.0),
        ('"never closed. you idiot "b"', 1.0),
        ('“never closed. you idiot “b”', 1.0),
        ('"one paragraph\n\n"you idiot" he read', 0.4),
        ('"you\n\nidiot" he read', 0.4),
        ('"one idiot\n\n"two" he read', 0.4),
        ('""idiot"" here', 0.4),
        ('" idiot " here', 0.4),
        ('"you idiot!"Next', 0.4),
        ('«a “b” idiot» c', 0.4),
        ('"idiot" here, idiot', 1.0),
    ],
)
def test_quotations_of_any_length(text, weight):
    assert toxicity.Model(exact={"idiot$": 0.9}).found(text) == {("idiot$", 0): weight}


def test_quotations_in_one_pass():
    text = '"idiot" “idiot “ „idiot “« ' * 40_000
    begin = time.monotonic()
    assert toxicity.Model(exact={"idiot$": 0.9}).found(text) and time.monotonic() - begin < 20
