"""Benchmark decontamination: a hash set of normalised test n-grams, scanned over all training windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, materialize, split_words, text_or_empty, window_hashes

#: Up to so many distinct windows the hash set (8 bytes each, 1.6 MB) stands in the plan, and the window table
#: (a few hundred bytes each) goes to every task.
BROADCAST_WINDOWS = 200_000
#: Beyond it hashes go to every task in blocks of so many (8 bytes each and their table, some 50 MB), one scan a block.
BLOCK_HASHES = 2_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words: ASCII but digits and lower-case letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OTHER_GAP = r"[\x00-\x1F\x21-\x2F\x3A-\x60\x7B-\x7F]"


def lowered(text: Column) -> Column:
    """A-Z lower-cased, nothing else; pure ASCII takes the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def normal_words(text: Column) -> Column:
    """Words of a text after lower-casing A-Z.

    Line ends, full stops and commas are replaced by plain searches; only texts that then still
    hold another gap character go through the regular expression.
    """
    plain = lowered(text)
    for mark in "\n.,":
        plain = F.replace(plain, F.lit(mark), F.lit(" "))
    plain = F.replace(plain, F.lit("  "), F.lit(" "))
    return split_words(bound(plain, lambda t: F.when(t.rlike(OTHER_GAP), F.regexp_replace(t, GAP, " ")).otherwise(t)))


def windows(bench: DataFrame, n: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows (gram, len, items): n consecutive words of an item, all of them where it has fewer.

    Items without words (null and empty texts) have no window.  Rows with equal ids are one item.
    """
    item = bench.select(F.col(id_col).cast("string").alias("item"), normal_words(text_or_empty(text_col)).alias("w")).where(F.size("w") > 0)
    item = item.withColumn("len", F.least(F.size("w"), F.lit(n)))
    gram = F.explode(F.expr("transform(sequence(1, size(w) - len + 1), i -> array_join(slice(w, i, len), ' '))"))
    return item.select("item", "len", gram.alias("gram")).groupBy("gram", "len").agg(F.array_sort(F.collect_set("item")).alias("items"))


def scan(docs: DataFrame, bench: DataFrame, n: int = 10, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep_row: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, spans, n_hit, items; with ``keep_row`` its row as a struct ``row``.

    spans are the verified occurrences (first word from 1, words); n_hit counts the words inside any
    of them; items are the ids, as sorted strings, of the benchmark items found.
    Null and empty texts have no words and no hits; repeated rows are judged each; ties do not
    arise; an empty benchmark leaves all documents clean; an empty table gives no rows.

    The scan holds each document's window hashes against the hash set where the document is, so only hits are
    ever shuffled, whatever the size of the benchmark; each hit is then verified by joining the window's words themselves.
    """
    grams = materialize(windows(bench, n, item_col, item_text_col), "bench-windows")
    small = grams.count() <= BROADCAST_WINDOWS
    lengths = [r[0] for r in grams.select("len").distinct().orderBy("len").collect()]  # at most n values
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_row else []
    base = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("doc_id"), normal_words(text_or_empty(text_col)).alias("w"), *row)
    kept = ["row"] if keep_row else []
    if small:
        found = []
        for length in lengths:
            hashes = [r[0] for r in grams.where(F.col("len") == length).select(F.expr(_hash_of_gram(length))).distinct().collect()]
            wanted = ", ".join(f"{h}L" if h > -(2**63) else "bigint(-9223372036854775807) - 1L" for h in hashes)
            at = f"filter(transform({window_hashes('w', length)}, (x, i) -> IF(x IN ({wanted}) AND i <= size(w) - {length}, i, NULL)), i -> i IS NOT NULL)"
            found.append(f"IF(size(w) >= {length}, transform({at}, i -> struct(i + 1 AS at, {length} AS len, {_gram('w', 'i', length)} AS gram)), {NO_HITS})")
        hits = f"concat({', '.join(found)})" if found else NO_HITS
        base = materialize(base.select("rid", "doc_id", F.size("w").cast("long").alias("n_words"), F.expr(hits).alias("hits"), *kept), "bench-hits")
        return _counted(_verified(base, grams, small, keep_row), keep_row)
    base = materialize(base, "bench-words")  # row numbers must be the same wherever they are used
    hits = None
    for length in lengths:
        own = materialize(grams.where(F.col("len") == length).select(F.expr(_hash_of_gram(length)).alias("hash")).distinct(), "bench-hashes")
        blocks = -(-own.count() // BLOCK_HASHES)
        places = base.where(F.size("w") >= length).select("rid", F.explode(F.expr(f"transform(slice({window_hashes('w', length)}, 1, size(w) - {length} + 1), (x, i) -> struct(i AS i, x AS hash))")).alias("p")).select("rid", "p.i", "p.hash")
        for block in range(blocks):
            part = F.broadcast(own.where(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == block))  # BLOCK_HASHES longs, about
            at = places.join(part, "hash", "left_semi").select("rid", F.col("i"), F.lit(length).alias("len"))
            hits = at if hits is None else hits.unionByName(at)
    gathered = materialize(hits, "bench-places").groupBy("rid").agg(F.collect_list(F.struct("i", "len")).alias("places"))
    gram = " ".join(["CASE", *[f"WHEN p.len = {n} THEN {_gram('w', 'p.i', n)}" for n in lengths], "END"])
    base = base.join(gathered, "rid", "left").select("rid", "doc_id", F.size("w").cast("long").alias("n_words"), F.expr(f"coalesce(transform(places, p -> struct(p.i + 1 AS at, p.len AS len, {gram} AS gram)), {NO_HITS})").alias("hits"), *kept)
    return _counted(_verified(materialize(base, "bench-hits"), grams, small, keep_row), keep_row)


NO_HITS = "cast(array() AS array<struct<at:int,len:int,gram:string>>)"


def _gram(words: str, at: str, n: int) -> str:
    return f"concat_ws(' ', {', '.join(f'get({words}, {at} + {k})' for k in range(n))})"


def _hash_of_gram(n: int) -> str:
    return f"({window_hashes("split(gram, ' ')", n)})[0]"


def _verified(base: DataFrame, grams: DataFrame, small: bool, keep_row: bool) -> DataFrame:
    """Hits whose words are a window's words, gathered by document; documents without hits stay where they are."""
    hit = base.select("rid", F.explode("hits").alias("hit")).select("rid", "hit.at", "hit.len", "hit.gram")
    true = hit.join(F.broadcast(grams) if small else grams, ["gram", "len"])
    per_row = true.groupBy("rid").agg(F.array_sort(F.collect_set(F.struct("at", "len"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    out = ["doc_id", "n_words", "spans", "items", *(["row"] if keep_row else [])]
    clean = base.where(F.size("hits") == 0).withColumn("spans", F.lit(None).cast("array<struct<at:int,len:int>>")).withColumn("items", F.lit(None).cast("array<string>"))
    return clean.select(*out).unionByName(base.where(F.size("hits") > 0).join(per_row, "rid", "left").select(*out))


def _counted(rows: DataFrame, keep_row: bool) -> DataFrame:
    """Words covered by spans sorted by their start: each adds what lies beyond the furthest end so far."""
    spans = F.coalesce("spans", F.array().cast("array<struct<at:int,len:int>>"))
    covered = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["at"] + x["len"] - F.greatest(acc["end"], x["at"]))).alias("n"), F.greatest(acc["end"], x["at"] + x["len"]).alias("end")
        ),
        lambda acc: acc["n"].cast("long"),
    )
    return rows.select("doc_id", "n_words", spans.alias("spans"), covered.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), *(["row"] if keep_row else []))


def decontaminate(docs: DataFrame, bench: DataFrame, n: int = 10, remove: str = "documents", *, text_col: str = "text", **names) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) without the words inside hits.

    Removing spans keeps the rest of each text byte by byte, the gap before a removed word going with it.
    Null and empty texts are clean and stay; repeated rows are judged alike; columns may have any names; an empty
    benchmark changes nothing, an empty table stays empty.
    """
    rows = scan(docs, bench, n, text_col=text_col, keep_row=True, **names)
    if remove == "documents":
        return rows.where(F.col("n_hit") == 0).select("row.*")
    if remove != "spans":
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    pieces = F.regexp_extract_all(F.col(f"row.`{text_col}`"), F.lit(rf"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*{word}"), F.lit(0))
    tail = F.regexp_extract(F.col(f"row.`{text_col}`"), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\z", 0)
    kept = F.filter("pieces", lambda x, i: ~F.exists("spans", lambda s: (i + 1 >= s["at"]) & (i + 1 < s["at"] + s["len"])))
    text = F.when(F.col("n_hit") == 0, F.col(f"row.`{text_col}`")).otherwise(F.concat(F.array_join(kept, ""), tail))
    rows = rows.withColumn("pieces", pieces).withColumn("row", F.col("row").withField(text_col, text))
    return rows.select("row.*")
