"""Suffix-array deduplication with sparse suffixes.

Only suffixes at minimiser positions are retained: in each window of 50 words the 8-word gram with the
least hash.  Suffixes are sorted, by the fingerprint of the first words and then of the words around the
position to the left and right that its windows cover; equal ones become neighbours, and comparing
neighbours finds those that repeat.  Matches are then extended left and right, window by window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textcols import SEQ, U, mix, prefix, ranges
from .windows import repeats_removed

GRAM = 8


def minimisers(words: np.ndarray, first: np.ndarray, end: np.ndarray):
    """Grams of GRAM words as anchors, the least hash first."""
    at = np.flatnonzero(np.arange(len(words)) + GRAM <= end)
    gram = ranges(prefix(words, SEQ), at, at + GRAM, SEQ)
    return mix(gram ^ U(SEQ)), gram, at, at + GRAM


RUN = "sig long, rows long, least long, most long, smallest {id}"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one signature in sorted suffixes; runs of one row only where the batch ends could hide more."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, content, doc = (np.asarray(batch.column(i)) for i in range(3))
        head = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        size = np.diff(np.append(head, len(sig)))
        out = [sig[head], size, np.minimum.reduceat(content, head), np.maximum.reduceat(content, head)]
        keep = size > 1
        keep[[0, -1]] = True
        smallest = pa.array(np.minimum.reduceat(doc, head)[keep], batch.schema.field(2).type)
        yield pa.RecordBatch.from_arrays([*(pa.array(x[keep].astype(np.int64)) for x in out), smallest], ["sig", "rows", "least", "most", "smallest"])


def sorted_neighbours(found: DataFrame) -> DataFrame:
    """Signatures of more than one suffix, from the sorted order.

    The sort is by ranges of (signature, content, document), so a signature with very many suffixes is spread over
    several tasks; its runs there are added up afterwards, one row for each.
    """
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["sig", "content", "doc"]
    runs = found.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_neighbours, RUN.format(id=dict(found.dtypes)["doc"].replace("bigint", "long")))
    sums = runs.groupBy("sig").agg(F.sum("rows").alias("rows"), (F.min("least") != F.max("most")).alias("mixed"), F.min("smallest").alias("smallest"))
    return sums.where("rows > 1").drop("rows")


def dedup_suffixes(docs: DataFrame, length: int = 50, *, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (with ``with_text`` also kept_text).

    Of each passage of at least ``length`` words that repeats across documents the occurrence in the smallest
    document stays and the others go: a word is removed if a window of ``length`` words that covers it also
    starts in a document with a smaller id.  ``length`` must be GRAM or more.
    Null and empty texts have no words; a null id counts as larger than any other, and comes back null; rows with
    equal ids don't remove from each other; repeated rows get equal results; an empty table gives no rows.
    """
    if length < GRAM:
        raise ValueError(f"length must be {GRAM} or more")
    return repeats_removed(docs, minimisers, length, settle=sorted_neighbours, id_col=id_col, text_col=text_col, with_text=with_text)
