"""Sharding by a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

ROUNDS = 6


class Feistel:
    """A keyed permutation of 0..n-1, computable both ways without a table.

    A balanced Feistel network permutes the smallest even number of bits that holds n; values at or
    above n walk on along their cycle until they are below.
    """

    def __init__(self, n: int, seed: int = 17):
        if n < 0:
            raise ValueError("n must not be negative")
        self.n, self.half = n, max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
        keys, x = [], seed & (2**64 - 1)
        for _ in range(ROUNDS):
            x = (x * 6364136223846793005 + 1442695040888963407) & (2**64 - 1)
            keys.append(x)
        self.keys = np.array(keys, np.uint64)

    def _round(self, right: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (right ^ key) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return (x >> np.uint64(32)) & np.uint64((1 << self.half) - 1)

    def _once(self, x: np.ndarray, inverse: bool) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        if inverse:
            for key in self.keys[::-1]:
                left, right = right ^ self._round(left, key), left
        else:
            for key in self.keys:
                left, right = right, left ^ self._round(right, key)
        return (left << half) | right

    def _walk(self, x: Sequence[int], inverse: bool) -> np.ndarray:
        x = np.asarray(x, np.uint64)
        if len(x) and int(x.max()) >= self.n:
            raise ValueError("a number is not below n")
        out = self._once(x, inverse)
        while len(over := np.flatnonzero(out >= self.n)):
            out[over] = self._once(out[over], inverse)
        return out.astype(np.int64)

    def permute(self, x: Sequence[int]) -> np.ndarray:
        return self._walk(x, False)

    def invert(self, y: Sequence[int]) -> np.ndarray:
        return self._walk(y, True)


def numbered(docs: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """``docs`` with ``row_number`` from 0 in the order of the columns ``order``, and the number of rows.

    Rows are sorted by range partitioning; a partition's rows are numbered from the count of rows
    before it.  Only one count per partition reaches the driver.  No task sees all rows.
    """
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = [F.col(c).asc_nulls_last() for c in order]
    placed = materialize(docs.repartitionByRange(parts, *ordered).sortWithinPartitions(*ordered).withColumn("at", F.monotonically_increasing_id()), "sharding-order")
    part = F.shiftright("at", 33)
    counts = {r[0]: r[1] for r in placed.groupBy(part.alias("part")).count().collect()}
    before, total = {}, 0
    for p in sorted(counts):
        before[p], total = total, total + counts[p]
    if not total:
        return placed.withColumn("row_number", F.col("at")).drop("at"), 0
    offsets = F.element_at(F.array(*[F.lit(before.get(p, 0)).cast("long") for p in range(max(counts) + 1)]), (part + 1).cast("int"))
    return placed.withColumn("row_number", offsets + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("at"), total


def place(docs: DataFrame, shards: int = 16, seed: int = 17, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, row_number, shard, slot under the law ``rows``.

    Rows are numbered by (doc_id, text checksum, size), nulls last; number r goes to place
    p = permutation(r), that is to shard p mod ``shards`` and slot p div ``shards``: counts differ by one at
    most, slots have no gap, and ``row_at`` computes who stands where.  size is UTF-8 bytes + 1.
    Null texts count as empty (size 1, checksum 0); rows equal in all three are told apart by their place
    in the input, which spreads them over tasks, and are exchangeable, so reruns give the same result; an empty
    table gives no rows.
    """
    text = text_or_empty(text_col)
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.monotonically_increasing_id().alias("tie"))
    rows, n = numbered(slim, ["doc_id", "text_crc32", "size", "tie"])
    feistel = Feistel(n, seed)

    @F.pandas_udf("long")
    def permuted(x: pd.Series) -> pd.Series:
        return pd.Series(feistel.permute(x.to_numpy()))

    rows = rows.withColumn("place", permuted("row_number"))
    return rows.select("doc_id", "size", "text_crc32", "row_number", F.pmod("place", F.lit(shards)).cast("int").alias("shard"), F.floor(F.col("place") / F.lit(shards)).cast("long").alias("slot"))


def row_at(n: int, shard: int, slot: int, shards: int = 16, seed: int = 17) -> int:
    """The global row number that stands at (shard, slot) of n rows."""
    return int(Feistel(n, seed).invert([slot * shards + shard])[0])


