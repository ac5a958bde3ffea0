"""Files of any store, hidden ones too: listed once on the driver by Spark's file system, read and written in tasks by pyarrow's."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from fnmatch import fnmatch

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def plain(path: str) -> str:
    """A path as Hadoop writes it: one slash after ``file:``."""
    return re.sub("^file:/+", "file:/", path)


def list_files(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, name, parent, size, modified) of files below ``root`` whose name matches the glob, by path; none if root is missing.

    Spark's own listing skips names that start with a dot or an underscore; this one doesn't.  ``root`` may be a file.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    rows = []
    if fs.exists(path):
        found = fs.listFiles(path, recursive)
        while found.hasNext():
            status = found.next()
            full = plain(status.getPath().toString())
            parent, _, name = full.rpartition("/")
            if fnmatch(name, pattern):
                rows.append((full, name, parent, status.getLen(), status.getModificationTime() / 1000))
    return spark.createDataFrame(sorted(rows), "path string, name string, parent string, size long, modified double")


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(path, is a folder) of what stands in a folder itself, hidden names too, by path; nothing if it is missing."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted((plain(s.getPath().toString()), s.isDirectory()) for s in fs.listStatus(at)) if fs.exists(at) else []


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """(file system, path in it) of a local path or a URI."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)


def read_bytes(path: str) -> bytes:
    fs, at = filesystem(path)
    with fs.open_input_stream(at) as f:
        return f.read()


def write_bytes(path: str, data: bytes) -> None:
    """Publish a file whole: it is written under another name first."""
    fs, at = filesystem(path)
    fs.create_dir(at.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(f"{at}.partial") as f:
        f.write(data)
    fs.move(f"{at}.partial", at)


def copy_to(path: str, source, size: int = 1 << 20) -> int:
    """Publish what a local file object holds, piece by piece; the bytes written."""
    fs, at = filesystem(path)
    fs.create_dir(at.rpartition("/")[0], recursive=True)
    total = 0
    with fs.open_output_stream(f"{at}.partial") as f:
        while piece := source.read(size):
            f.write(piece)
            total += len(piece)
    fs.move(f"{at}.partial", at)
    return total


def exists(path: str) -> bool:
    fs, at = filesystem(path)
    return fs.get_file_info(at).type != pyarrow.fs.FileType.NotFound


def remove(path: str) -> None:
    """Delete a file or folder; one that isn't there is fine."""
    fs, at = filesystem(path)
    match fs.get_file_info(at).type:
        case pyarrow.fs.FileType.File:
            fs.delete_file(at)
        case pyarrow.fs.FileType.Directory:
            fs.delete_dir(at)


def with_text(files: DataFrame, column: str = "path", name: str = "text") -> DataFrame:
    """``files`` with the content of each as UTF-8 text; null if there is no such file or it is no text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path in batch.column(batch.schema.get_field_index(column)).to_pylist():
                try:
                    out.append(read_bytes(path).decode())
                except (OSError, UnicodeDecodeError):
                    out.append(None)
            yield batch.append_column(name, pa.array(out, pa.string()))

    return files.mapInArrow(run, ", ".join([*[f"`{n}` {t}" for n, t in files.dtypes], f"`{name}` string"]))


def classified(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, kind): zip, dir, file or missing of each path, written as ``list_files`` writes it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for given in paths:
        path = jvm.org.apache.hadoop.fs.Path(given)
        fs = path.getFileSystem(conf)
        kind = "missing" if not fs.exists(path) else "dir" if fs.getFileStatus(path).isDirectory() else "zip" if given.lower().endswith(".zip") else "file"
        rows.append((plain(fs.makeQualified(path).toString()), kind))
    return spark.createDataFrame(rows, "path string, kind string")


def is_real_member(name: Column) -> Column:
    """Whether an archive's entry is a file, not a folder or what macOS adds."""
    return ~name.startswith("__MACOSX") & ~name.endswith("/")


def is_tiff(name: Column) -> Column:
    return is_real_member(name) & name.rlike(r"(?i)\.tiff?$")


def parent_of(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]+/?$", "")
