"""Recompression of TIFFs in archives, folders and single files: a row per file, judged input by input."""

from __future__ import annotations

import re
import struct
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.records import job_summary
from ..sources import archives, files, tiff

JOB = "input string, member string, output string, success boolean, input_size long, output_size long, error string"
COMPRESSIONS = ("zlib", "lzw", "lzma", "zstd")


def _target(out_dir: str, folder: str, member: str, is_tiff: bool) -> str:
    """Where a member is written; TIFFs end in ``.tif``.  Raises ValueError for a name that leads out of the folder."""
    parts = member.replace("\\", "/").split("/")
    if member.startswith(("/", "\\")) or ".." in parts or re.match(r"^[A-Za-z]:", member):
        raise ValueError(f"unsafe name {member!r}")
    name = re.sub(r"\.[^./]+$", "", "/".join(parts)) + ".tif" if is_tiff else "/".join(parts)
    return "/".join(x for x in (out_dir.rstrip("/"), folder, name) if x)


def _processed(out_dir: str, compression: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string())
        opened = archives.Opened()
        for batch in batches:
            rows = []
            for job in batch.to_pylist():
                out, size_in, size_out, error = None, 0, 0, job["error"]
                try:
                    if error is None:
                        out = _target(out_dir, job["folder"], job["member"], job["tiff"])
                        data = opened.read(job["input"], job["member"], job["place"]) if job["zipped"] else files.read_bytes(job["path"])
                        size_in = len(data)
                        data = tiff.recompressed(data, compression) if job["tiff"] else data
                        files.write_bytes(out, data)
                        size_out = len(data)
                except (*tiff.BROKEN, OSError, zipfile.BadZipFile, struct.error) as e:
                    error = str(e) or type(e).__name__
                rows.append((job["input"], job["member"], out, error is None, size_in, size_out, error))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["input", "member", "output", "success", "input_size", "output_size", "error"])
        opened.close()

    return run


def jobs(spark: SparkSession, inputs: Sequence[str]) -> DataFrame:
    """(input, zipped, folder, member, path, tiff, error, place): a row for each file of archives, folders (recursive) and single files.

    Inputs that don't exist have none.  An archive that can't be read, or an empty one, has a row with its error.
    """
    kinds = files.classified(spark, inputs)
    zips = kinds.where("kind = 'zip'").select("path")
    stem = F.regexp_replace(F.regexp_extract("zip", "([^/]+)$", 1), r"\.[^.]+$", "")
    rows = archives.members(zips)
    none = zips.join(rows, F.col("path") == F.col("zip"), "left_anti").select(F.col("path").alias("zip"), F.lit(None).cast("string").alias("member"), F.lit("no files").alias("error"), F.lit(False).alias("tiff"), F.lit(None).cast(archives.PLACE).alias("place"))
    rows = rows.select("zip", "member", "error", "tiff", "place").unionByName(none)
    out = rows.select(F.col("zip").alias("input"), F.lit(True).alias("zipped"), stem.alias("folder"), "member", F.lit(None).cast("string").alias("path"), "tiff", "error", "place")
    for path, kind in kinds.where("kind IN ('dir', 'file')").collect():  # as many as were given by hand
        listed = files.list_files(spark, path)
        root = path.rstrip("/") + "/"
        member = F.substr("path", F.lit(len(root) + 1)) if kind == "dir" else F.col("name")
        folder = path.rstrip("/").rpartition("/")[2] if kind == "dir" else ""
        source = path if kind == "dir" else "files"
        listed = listed.select(F.lit(source).alias("input"), F.lit(False).alias("zipped"), F.lit(folder).alias("folder"), member.alias("member"), "path", files.is_tiff(F.col("name")).alias("tiff"), F.lit(None).cast("string").alias("error"), F.lit(None).cast(archives.PLACE).alias("place"))
        out = out.unionByName(listed)
    return out


def process(work: DataFrame, out_dir: str, compression: str = "zlib") -> DataFrame:
    """Run jobs, each member in a task of its own turn: (input, member, output, success, input_size, output_size, error).

    TIFFs are rewritten and read back, others copied.  A task reads its members of an archive in the order of the archive,
    each at its place, so an archive's directory is read once, by the listing.  Evaluate the result once.
    """
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression must be one of {', '.join(COMPRESSIONS)}, not {compression!r}")
    parts = int(work.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return work.repartition(parts, "input", "member").sortWithinPartitions("input", "place.nth").mapInArrow(_processed(out_dir, compression), JOB)


def compress_tiffs(spark: SparkSession, inputs: Sequence[str], out_dir: str, materialize, compression: str = "zlib", delete_originals: bool = False, dry_run: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """(results by file, summary): processed, succeeded, failed inputs and deleted archives; failed is -1 without any input.

    An archive succeeds as a whole or not at all.  Originals are deleted only of archives that succeeded, and not in a dry
    run (which writes outputs all the same).  ``materialize`` runs the jobs once and gives their results back.
    """
    results = materialize(process(jobs(spark, inputs), out_dir, compression), "recompressed")
    by_input = job_summary(results, ["input"]).collect()  # a row for each input given
    summary = {"processed": len(by_input), "succeeded": sum(r["ok"] for r in by_input), "failed": sum(not r["ok"] for r in by_input), "deleted": 0}
    if not by_input:
        return results, summary | {"failed": -1}
    if delete_originals and not dry_run:
        for r in by_input:
            if r["ok"] and r["input"].lower().endswith(".zip"):
                files.remove(r["input"])
                summary["deleted"] += 1
    return results, summary
