"""Shared helpers: scratch tables in the cluster's shared folder and word patterns."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a null id wherever ids are ordered: a null comes last.
NULL_ID = 2**63 - 1
#: Scratch folder of a local application whose session names none.
_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where that is unset, a local one in a local session, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:  # the setting can't be changed in a running session
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _LOCAL.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="wellspan-")
        _LOCAL[spark.sparkContext.applicationId] = root
    return f"{root.rstrip('/')}/wellspan-{spark.sparkContext.applicationId}"


#: Rows of an Arrow batch where rows carry whole texts.
WIDE_ROWS = 1000


def release() -> None:
    """Give back to the system what this worker has freed: numpy and Arrow keep freed memory, and workers live on between stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable) -> Callable:
    """A function over batches that releases memory after each batch it gives, and at its end."""

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch
            del batch
            release()
        release()

    return released


def by_few_rows(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` for rows that carry whole texts: ``run`` gets slices of WIDE_ROWS rows at most."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(b.slice(i, WIDE_ROWS) for b in batches for i in range(0, b.num_rows, WIDE_ROWS))

    return df.mapInArrow(lean(sliced), schema)


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table to the shared folder, in one folder for each value of ``by`` if given, and read it back.

    This cuts the lineage, so a lost executor costs a reread, not a recomputation, and it lets the
    table be used by several branches of a plan at the price of one.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables written by ``materialize`` that no plan reads any more, and let Spark drop their shuffles."""
    for table in tables:
        _delete(table.sparkSession, table._scratch_path)
    drop_shuffles(tables[0].sparkSession)


def discard_part(table: DataFrame, folder: str) -> None:
    """Delete one folder of a table written ``by`` a column, where no plan reads its rows any more, and drop shuffles too."""
    _delete(table.sparkSession, f"{table._scratch_path}/{folder}")
    drop_shuffles(table.sparkSession)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of what has been written: they stay until the driver's JVM collects its garbage."""
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("string")


class Ids:
    """Ids of a column as values that order with nulls last: ``encode`` gives them, ``decode`` the ids back.

    Integers become longs (2**63 - 1 stands for null), all other types strings in string order.
    """

    def __init__(self, df: DataFrame, column: str):
        kind = df.select(F.col(f"`{column}`")).dtypes[0][1]
        self.column, self.given = column, kind
        self.type = "long" if kind in ("tinyint", "smallint", "int", "bigint") else "string"

    def encode(self) -> Column:
        value = F.col(f"`{self.column}`")
        if self.type == "long":
            return F.coalesce(value.cast("long"), F.lit(NULL_ID))
        return F.when(value.isNull(), "1").otherwise(F.concat(F.lit("0"), value.cast("string")))

    def decode(self, value: str | Column) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        if self.type == "long":
            return F.nullif(value, F.lit(NULL_ID)).cast(self.given)
        return F.when(F.startswith(value, F.lit("0")), F.substr(value, F.lit(2))).cast(self.given)


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def split_words(spaced: Column) -> Column:
    """Split at runs of spaces; texts without two spaces in a row take String.split's fast path."""
    none = F.array().cast("array<string>")
    return bound(F.trim(spaced), lambda t: F.when(t == "", none).when(F.contains(t, F.lit("  ")), F.split(t, " +")).otherwise(F.split(t, " ")))


def words(text: Column) -> Column:
    """Array of the words of a non-null text, unchanged."""
    for white in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(white), F.lit(" "))
    return split_words(text)


def word_count(text: Column) -> Column:
    """Number of words of a non-null text."""
    return F.size(words(text)).cast("long")


def window_hashes(words: str, n: int) -> str:
    """SQL for the hashes of all windows of n consecutive elements, null past the last window's start.

    Hashes of 2, 4, 8, ... elements are built by doubling, each from two that are there, in constant
    time an element (``slice`` would copy its whole array at every call); n is their binary sum.
    """
    step, have, at = 1, "h1", 0
    body, result = [], None
    while step <= n:
        if n & step:
            if result is None:
                result = have
            else:
                name = f"r{step}"
                body.append((name, f"transform({have}, (x, i) -> xxhash64(x, get({result}, i + {step})))"))
                result = name
            at += step
        if 2 * step <= n:
            name = f"h{2 * step}"
            body.append((name, f"transform({have}, (x, i) -> xxhash64(x, get({have}, i + {step})))"))
            have = name
        step *= 2
    out = result
    for name, value in reversed(body):
        out = f"transform(array({value}), {name} -> {out})[0]"
    return f"transform(array(transform({words}, x -> xxhash64(x))), h1 -> {out})[0]"
