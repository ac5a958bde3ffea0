"""Mixing sources to target weights: floor(rate) copies plus one hash-seeded Bernoulli copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_or_empty, word_count

#: At most so many sources are sent to every task (about 100 bytes each); beyond it the sources are
#: joined by a shuffle in which each source is spread over SALTS tasks.
BROADCAST_SOURCES = 10_000
SALTS = 64


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Targets and rates per source from a table (source, size) of documents.

    Sources in code point order, null last, take ``weights`` in turn and divide ``share`` times the sum
    of all sizes.  A target stops at ``cap`` times its source's size; what it leaves goes to the
    others by weight.  That is water filling, and has a closed form: with sources ordered by
    cap * size / weight, the level is found by running sums, with no iteration.
    A source without words has target 0 and rate 0.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source: the windows below see sources, never documents.
    totals = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    totals = totals.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    by_room = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy()
    level = totals.select(
        "*",
        F.coalesce(F.sum("most").over(by_room) - F.col("most"), F.lit(0.0)).alias("full_before"),
        (F.sum("weight").over(every) - F.sum("weight").over(by_room) + F.col("weight")).alias("weight_left"),
        (F.sum("source_size").over(every) * F.lit(float(share))).alias("wanted"),
    ).withColumn("own_level", (F.col("wanted") - F.col("full_before")) / F.col("weight_left"))
    # The level is the first at which the source itself, and so all after it, stays under its cap.
    found = F.min(F.when(F.col("own_level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), F.col("rank"), F.col("own_level")))).over(every)
    target = F.coalesce(F.least(F.col("most"), found["own_level"] * F.col("weight")), F.col("most"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return level.select("source", F.col("source_size").cast("long").alias("source_size"), target.alias("target"), rate.alias("rate"))


def unit_hash(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the columns alone, so reruns agree: 52 bits of an md5."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *columns)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def mixed(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, *, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep_row: bool = False) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, rate, copies, taken; with ``keep_row`` its row as a struct ``row``.

    size is the number of words; copies = floor(rate) plus one with the probability of the rate's
    fraction, drawn from a hash of seed, id and text; taken = copies * size.
    Null and empty texts have size 0 and take nothing; a null source is a source of its own, the
    last; rows with the same id and text draw the same copies; an empty table gives no rows.
    Where at most ``BROADCAST_SOURCES`` sources exist their table is broadcast, else each source's row
    is spread over ``SALTS`` keys and joined by a shuffle, so a hot source meets many tasks.
    """
    text = text_or_empty(text_col)
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_row else []
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text).alias("size"), F.md5(text).alias("text_md5"), *row)
    if not keep_row:
        base = materialize(base, "mix-sizes")  # a few dozen bytes a document; texts are read once
    targets = materialize(source_targets(base.select("source", "size"), weights, share, cap), "mix-sources").withColumnRenamed("source", "its_source")
    same = F.col("source").eqNullSafe(F.col("its_source"))
    if targets.count() <= BROADCAST_SOURCES:
        joined = base.join(F.broadcast(targets), same, "left")
    else:
        spread = targets.withColumn("its_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = base.withColumn("salt", F.pmod(F.xxhash64("text_md5"), F.lit(SALTS)).cast("int")).join(spread, same & (F.col("salt") == F.col("its_salt")), "left")
    whole = F.floor("rate")
    drawn = unit_hash(seed, F.col("doc_id").cast("string"), F.col("text_md5")) < F.col("rate") - whole
    joined = joined.withColumn("copies", (whole + F.when(drawn, 1).otherwise(0)).cast("long"))
    return joined.select("doc_id", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"), *(["row"] if keep_row else []))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, **names) -> DataFrame:
    """The mixture itself: every row as often as it is taken, with exactly the columns of ``docs``.

    Null and empty texts have no words and are taken floor(rate) times or once more like others of their source; a null
    source is one of its own; rows with one id and text are taken alike; an empty table gives an empty one.
    """
    rows = mixed(docs, weights, share, cap, keep_row=True, **names).where(F.col("copies") > 0)
    return rows.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select("row.*")
