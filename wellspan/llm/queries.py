"""The queries of this subpackage: thin derivations from the operators, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cascade, decontaminate, jaccard, mixing, sharding, substring_dedup, suffix_dedup, toxicity, urlrules, weak_quality


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    labelled = urlrules.page_labels(pages, _table(spark, sf_dir, "labels"))
    return urlrules.judged(labelled.select("row.*", "bad"), F.col("bad")).select("page_id", "host", "path", "rule", "verdict", "template", "bad_share")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def held_out(column: str = "doc_id"):
    """Whether a document is never learned from; one without an id isn't learned from either."""
    return F.col(column).isNull() | (F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").where(~held_out()))
    rows = toxicity.scored(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_suffixes(_table(spark, sf_dir, "documents"))


def op7_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.quality(_table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cascade.judged(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.place(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mixing, op2_url_filter, op3_substring_dedup, op4_jaccard_join, op5_toxicity, op6_suffix_dedup, op7_weak_quality, op8_decontaminate, op9_quality_rules, op10_sharding)}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1 = rf"""
WITH base AS (SELECT doc_id, source, len({_WORDS}) AS size, md5(coalesce(text, '')) AS text_md5 FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM totals),
weighted AS (SELECT *, CAST([3, 1, 2][rank % 3 + 1] AS DOUBLE) AS weight, source_size * CAST(2.0 AS DOUBLE) AS most FROM ranked),
level AS (SELECT *,
    sum(most) OVER (ORDER BY most / weight, rank ROWS UNBOUNDED PRECEDING) - most AS full_before,
    sum(weight) OVER () - sum(weight) OVER (ORDER BY most / weight, rank ROWS UNBOUNDED PRECEDING) + weight AS weight_left,
    CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) AS wanted FROM weighted),
own AS (SELECT *, (wanted - full_before) / weight_left AS own_level FROM level),
found AS (SELECT arg_min(own_level, most / weight * 1000000 + rank) AS pos FROM own WHERE own_level * weight <= most),
targets AS (SELECT source, source_size, coalesce(least(most, pos * weight), most) AS target FROM own LEFT JOIN found ON true),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
    CAST(size * (floor(rate) + CASE WHEN CAST(('0x' || substr(md5(concat_ws('|', '17', CAST(doc_id AS VARCHAR), text_md5)), 1, 13)) AS BIGINT) / 4503599627370496.0 < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM base JOIN rates ON base.source IS NOT DISTINCT FROM rates.source
"""

_OP3 = rf"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS} AS w FROM documents),
spans AS (SELECT rid, doc_id, unnest(range(1, len(w) - 48)) AS pos, w FROM docs WHERE len(w) >= 50),
windows AS (SELECT rid, doc_id, pos, md5(array_to_string(w[pos:pos + 49], ' ')) AS h FROM spans),
firsts AS (SELECT h, min(doc_id) AS smallest FROM windows GROUP BY h),
late AS (SELECT rid, pos FROM windows JOIN firsts USING (h) WHERE doc_id > smallest),
gone AS (SELECT DISTINCT rid, unnest(range(pos, pos + 50)) AS i FROM late),
words AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def jaccard_sql(k: int, percent: int) -> str:
    """CTEs ``sets`` (doc_id, s) and ``named`` (doc_id, component_id) over a table ``documents``."""
    return rf"""
docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + {k - 1}], ' ') for i in range(1, len(w) - {k - 2})]) END AS s FROM docs),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * n >= {percent} * (len(x.s) + len(y.s) - n)),
reach AS (SELECT doc_id AS node, doc_id AS other FROM sets
    UNION SELECT node, CASE WHEN other = a THEN b ELSE a END FROM reach JOIN links ON other = a OR other = b),
named AS (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node)"""


_OP4 = f"WITH RECURSIVE {jaccard_sql(3, 90)} SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN named USING (doc_id)"


def contamination_sql() -> str:
    """CTEs ``words`` (rid, doc_id, w) of ``documents`` and ``hits`` (rid, pos, len, item_id)."""
    pattern = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return f"""
item AS (SELECT item_id, regexp_extract_all({_LOWER}, {pattern}) AS w FROM benchmark),
gram AS (SELECT DISTINCT item_id, least(len(w), 10) AS len, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
words AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, {pattern}) AS w FROM documents),
lens AS (SELECT DISTINCT len FROM gram),
spans AS (SELECT rid, w, len, unnest(range(1, len(w) - len + 2)) AS pos FROM words JOIN lens ON len(w) >= len),
hits AS (SELECT rid, pos, s.len AS len, item_id FROM (SELECT rid, len, pos, array_to_string(w[pos:pos + len - 1], ' ') AS g FROM spans) s JOIN gram USING (g, len))"""


_OP8 = f"""
WITH {contamination_sql()},
covered AS (SELECT rid, count(DISTINCT i) AS n FROM (SELECT rid, unnest(range(pos, pos + len)) AS i FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(found.n, 0) AS BIGINT) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)
"""

_OP9 = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
spans AS (SELECT rid, w, unnest(range(1, len(w) - 6)) AS pos FROM docs WHERE len(w) >= 8),
windows AS (SELECT rid, pos, array_to_string(w[pos:pos + 7], ' ') AS g FROM spans),
twice AS (SELECT rid, g FROM windows GROUP BY ALL HAVING count(*) > 1),
repeats AS (SELECT rid, count(DISTINCT i) AS n FROM (SELECT rid, unnest(range(pos, pos + 8)) AS i FROM windows SEMI JOIN twice USING (rid, g)) GROUP BY rid),
base AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST((SELECT count(x) - count(DISTINCT x) FROM (SELECT unnest(string_split(text, chr(10))) AS x) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')) AS BIGINT) AS n_dup_lines,
    len(string_split(text, chr(10))) AS n_lines, len(list_distinct(w)) AS n_distinct, length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) AS n_letters,
    coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest_word, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words
    FROM docs LEFT JOIN repeats USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 4 * n_symbols > word_chars OR 2 * n_dup_lines > n_lines
        OR 2 * n_letters < word_chars OR 50 * n_distinct < n_words OR longest_word > 1000) AS kept
FROM base
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": _OP1, "op3_substring_dedup": _OP3, "op4_jaccard_join": _OP4, "op6_suffix_dedup": _OP3, "op8_decontaminate": _OP8, "op9_quality_rules": _OP9}
