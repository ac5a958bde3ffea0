"""Preview frames of compiled films: 8 bits, stretched and scaled down.  Encoding them as video is left to other tools."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import stem, stem_kept
from ..operators.records import evenly
from ..sources import files, tiff

FRAME = "stem string, frame int, h int, w int, px binary, input_size long, output_size long, error string"


def preview(data: bytes, scale: int = 2, low: float = 0.5, high: float = 99.5, most: int = 24) -> list[np.ndarray]:
    """8-bit frames of a film: those of its first page's size, contrast from percentiles of at most ``most`` spread frames."""
    pages = tiff.decode_all(data)
    pages = [p for p in pages if p.shape == pages[0].shape]
    lo, hi = np.percentile(np.stack([pages[i] for i in evenly(len(pages), most)]), (low, high))
    out = []
    for page in pages:
        f = np.clip((page.astype(float) - lo) / max(hi - lo, 1.0) * 255, 0, 255).astype(np.uint8)
        h, w = f.shape[0] // scale, f.shape[1] // scale
        out.append(f[: h * scale, : w * scale].reshape(h, scale, w, scale).mean(axis=(1, 3)).astype(np.uint8))
    return out


def _frames(scale: int, low: float, high: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.string())
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    data = files.read_bytes(row["path"])
                    rows = [(row["stem"], i, *f.shape, f.tobytes(), len(data), f.size, None) for i, f in enumerate(preview(data, scale, low, high))]
                except (*tiff.BROKEN, OSError) as e:
                    rows = [(row["stem"], None, None, None, None, None, None, str(e))]
                for i in range(0, len(rows), 8):
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[i : i + 8]], t) for k, t in enumerate(types)], ["stem", "frame", "h", "w", "px", "input_size", "output_size", "error"])

    return run


def films(spark: SparkSession, in_dir: str, exclude: Sequence[str] = ("BF",), include: Sequence[str] = (), done: DataFrame | None = None) -> DataFrame:
    """(path, stem) of the ``*.ome.tif`` files directly in a folder, by name, that are wanted and, given ``done`` (stem), not done yet."""
    found = files.list_files(spark, in_dir, "*.ome.tif", recursive=False).select("path", stem(F.col("name")).alias("stem"))
    found = found.where(stem_kept(F.col("stem"), exclude, include))
    return found.join(done.select("stem").distinct(), "stem", "left_anti").select("path", "stem") if done is not None else found


def preview_frames(found: DataFrame, scale: int = 2, low: float = 0.5, high: float = 99.5) -> DataFrame:
    """(stem, frame, h, w, px, input_size, output_size, error): preview frames of films (path, stem), a film a task; a film that fails has one row with its error."""
    return found.repartition(max(1, min(found.count(), 2000)), "stem").mapInArrow(_frames(scale, low, high), FRAME)


def film_results(frames: DataFrame) -> DataFrame:
    """(stem, input_size, output_size, error): a row per film."""
    return frames.groupBy("stem").agg(F.max("input_size").alias("input_size"), F.sum("output_size").alias("output_size"), F.max("error").alias("error"))
