"""URL filters: domain and path rules, then path-template trees judged by smoothed labelled purity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: The fixed rules of the query: (verdict, host/path).
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))

#: Finished branches of the tree are written together when there are this many tables of them.
TABLES = 16
#: A node with more children than this has a variable segment: children below 1/CHILDREN of its pages become ``*``.
CHILDREN = 16
#: Branches whose labelled rates differ by fewer standard errors than this are merged.
SIGMAS = 1.96


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does.

    A rule ``h/p`` fits host h and its subdomains where the path starts with ``/p``.  Rules of equal
    length are tried in their given order.
    """
    rule = verdict = None
    for word, text in sorted(rules, key=lambda r: -len(r[1])):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        rule = (F if rule is None else rule).when(fits, F.lit(text))
        verdict = (F if verdict is None else verdict).when(fits, F.lit(word))
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def shape(path: Column) -> Column:
    """All segments of a path, digits generalised: /en/12.html gives [en, #.html]."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.transform(parts, lambda x: F.regexp_replace(x, "[0-9]+", "#"))


def _families(children: Column) -> Column:
    """Families of a node's children, an array of (child, labelled, bad) ordered by rate: those whose rates don't differ.

    Each child is held against the family so far by a two-sample test of their pooled rate; where they differ by SIGMAS
    standard errors or more a new family begins.  A node has CHILDREN such children at most, as rarer ones are one.
    """

    def add(families: Column, x: Column) -> Column:
        last = F.element_at(families, -1)
        n, k = last["labelled"], last["bad"]
        rate = (k + x["bad"]) / (n + x["labelled"])
        error = F.sqrt(rate * (1 - rate) * (1 / n + 1 / x["labelled"]))
        near = F.abs(k / n - x["bad"] / x["labelled"]) <= F.lit(SIGMAS) * error
        fresh = F.struct(F.array(x["child"]).alias("names"), x["labelled"].alias("labelled"), x["bad"].alias("bad"))
        joined = F.struct(F.concat(last["names"], F.array(x["child"])).alias("names"), (n + x["labelled"]).alias("labelled"), (k + x["bad"]).alias("bad"))
        rest = F.slice(families, F.lit(1), F.size(families) - 1)
        return F.when(F.size(families) == 0, F.array(fresh)).when(near, F.concat(rest, F.array(joined))).otherwise(F.concat(families, F.array(fresh)))

    empty = F.array().cast("array<struct<names:array<string>,labelled:bigint,bad:bigint>>")
    return F.aggregate(children, empty, add)


def template_tree(shapes: DataFrame) -> DataFrame:
    """(host, shape, template) for a table (host, shape, pages, labelled, bad) with one row per host and shape.

    Level by level the children of each node (host, template so far) are counted.  In a node with many children the rare
    ones are generalised into one, ``*``.  Branches are then merged with each other: children whose labelled rates don't
    differ are one family (``+`` if all of a node's are, else ``(a|b)`` by their names); children without labels, of which
    nothing is known, are ``+``.  Levels go on until no shape has a further segment; each is written, so the plan stays one
    level large.  A shape alone in its node has no sibling to differ from: what follows is merged at once.
    All levels work on shapes, of which there are fewer than pages, by grouped sums.
    """
    level, ended, depth = materialize(shapes.withColumn("template", F.lit("")), "url-level"), [], 0
    columns, node = level.columns, ["host", "template"]
    while not level.where(F.size("shape") > depth).isEmpty():
        level = level.withColumn("child", F.coalesce(F.get("shape", F.lit(depth)), F.lit("")))
        child = level.groupBy(*node, "child").agg(F.count("*").alias("shapes"), *[F.sum(c).alias(c) for c in ("pages", "labelled", "bad")])
        sums = child.groupBy(*node).agg(F.count_if(F.col("child") != "").alias("n_children"), F.sum("shapes").alias("node_shapes"), F.sum("pages").alias("node_pages"))
        both = child.join(sums, node)
        rare = (F.col("n_children") > CHILDREN) & (F.col("pages") * CHILDREN < F.col("node_pages"))
        both = materialize(both.withColumn("branch", F.when(F.col("child") == "", "").when(rare, "*").otherwise(F.col("child"))), "url-children")
        branch = both.where("branch <> ''").groupBy(*node, "branch").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).where("labelled > 0")
        ordered = F.array_sort(F.collect_list(F.struct((F.col("bad") / F.col("labelled")).alias("rate"), F.col("branch").alias("child"), "labelled", "bad")))
        families = branch.groupBy(*node).agg(ordered.alias("children"))  # CHILDREN + 1 of a node at most
        families = families.select(*node, _families(F.transform("children", lambda x: F.struct(x["child"], x["labelled"], x["bad"]))).alias("families"))
        one = families.select(*node, F.size("families").alias("n_families"), F.explode("families.names").alias("names"))
        label = F.when(F.col("n_families") == 1, "+").when(F.size("names") == 1, F.col("names")[0]).otherwise(F.concat(F.lit("("), F.array_join(F.array_sort("names"), "|"), F.lit(")")))
        steps = one.select(*node, F.explode("names").alias("branch"), label.alias("label"))
        step = F.when(F.col("branch") == "", "").otherwise(F.concat(F.lit("/"), F.coalesce("label", F.lit("+"))))
        named = both.join(steps, [*node, "branch"], "left").select(*node, "child", step.alias("step"), (F.col("node_shapes") == 1).alias("alone"))
        level = level.join(named, [*node, "child"])
        step = F.when(F.col("alone"), F.repeat(F.lit("/+"), F.size("shape") - depth)).otherwise(F.col("step"))
        level = materialize(level.withColumn("template", F.concat("template", step)).select(*columns, (F.col("alone") | (F.size("shape") <= depth)).alias("ended")), "url-level")
        ended.append(level.where("ended").select(*columns))
        if len(ended) == TABLES:
            ended = [materialize(reduce(DataFrame.union, ended), "url-ended")]
        level, depth = level.where("NOT ended").select(*columns), depth + 1
    return reduce(DataFrame.union, ended, level).select("host", "shape", "pages", "labelled", "bad", "template")


def judged_templates(shapes: DataFrame, reject_at: float = 0.5, prior_weight: float = 4.0) -> DataFrame:
    """(host, shape, template, bad_share, verdict): a template is rejected where the smoothed share of bad labels reaches ``reject_at``.

    Its purity is 1 - bad_share; bad_share = (bad + prior_weight * overall rate) / (labelled + prior_weight): a template without labels
    has the overall rate, so it stands or falls with the whole table.
    """
    tree = template_tree(shapes)
    whole = shapes.agg(F.coalesce(F.sum("bad") / F.nullif(F.sum("labelled"), F.lit(0)), F.lit(0.0))).first()[0]
    sums = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    share = (F.col("bad") + F.lit(prior_weight * float(whole))) / (F.col("labelled") + F.lit(float(prior_weight)))
    sums = sums.select("host", "template", share.alias("bad_share"))
    return tree.select("host", "shape", "template").join(sums, ["host", "template"]).withColumn("verdict", F.when(F.col("bad_share") >= reject_at, "block").otherwise("allow"))


def judged(pages: DataFrame, bad: Column | None = None, rules: Sequence[tuple[str, str]] = RULES, *, id_col: str = "page_id", url_col: str = "url", reject_at: float = 0.5) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, bad_share.

    ``bad`` is 1 for pages labelled bad, 0 for good ones, null for those without a label.  The longest
    fitting rule decides; where none fits the page's template does.
    Null urls and urls without ``://`` have an empty host and path, a template of their own and are
    judged like others; equal rows get equal verdicts; an empty table gives no rows.
    Shapes are summed before anything else is shuffled, and a hot host's pages meet their shape's one row.
    """
    host, path = host_and_path(F.col(url_col))
    bad = F.lit(None).cast("int") if bad is None else bad
    base = materialize(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), shape(path).alias("shape"), bad.cast("int").alias("bad")), "url-parts")
    shapes = base.groupBy("host", "shape").agg(F.count("*").alias("pages"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    verdicts = materialize(judged_templates(materialize(shapes, "url-shapes"), reject_at), "url-verdicts").withColumnRenamed("verdict", "method")
    joined = base.drop("bad").join(verdicts, ["host", "shape"], "left")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return joined.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.col("method")).alias("verdict"), "template", "bad_share")


def page_labels(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """(row, bad): ``pages`` rows as structs with the quality label of the document they show (1 where quality is 0), null without one.

    A page shows the document whose number ends its path: pages of the tables this is made for hold that document's text.
    Of several labels for a document the worst counts; null ids and labels are no labels; pages without a url, a number or
    a label get null; repeated pages stay; columns may have any names; an empty table of pages gives no rows, one of
    labels gives nulls.
    """
    _, path = host_and_path(F.col(f"`{url_col}`"))
    number = F.regexp_extract(path, r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1).try_cast("bigint")
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), number.alias("number"))
    worst = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("its_number")).agg((1 - F.min("quality")).alias("bad"))
    return rows.join(worst, F.col("number") == F.col("its_number"), "left").select("row", "bad")
