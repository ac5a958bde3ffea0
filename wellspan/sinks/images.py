"""Stacks as OME-TIFF files and as OME-Zarr folders, written in tasks; a stack that fails is reported and stops nothing else."""

from __future__ import annotations

import json
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ngff
from ..operators import planes as ops
from ..sources import files, tiff
from ..sources.catalog import EXTRAS

RESULT = "stack string, path string, success boolean, size long, error string"
#: Side of a chunk along Y and X.
SIDE = 512
#: Entry of a dataset's own metadata: how many planes it has, where it lacks some.
STORED = "StoredPlanes"


def _results(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["stack", "path", "success", "size", "error"])


def ome_description(meta: dict, present: Sequence[tuple[int, int, int]] | None = None) -> str:
    """OME-XML of a stack's metadata: what the format has a place for stands there, the rest is a JSON description.

    ``present``: (t, c, z) of each page of a stack that lacks planes.
    """
    extras = {k: v for k, v in meta.items() if k not in ngff.STANDARD and k != "sizes" and v is not None}
    pixels = {k: meta.get(k) for k in ("PhysicalSizeX", "PhysicalSizeY", "PhysicalSizeZ", "PhysicalSizeXUnit", "PhysicalSizeYUnit", "TimeIncrement", "TimeIncrementUnit")}
    sizes = meta["sizes"]
    times = meta.get("RelativeTimes") or []
    planes, there = [], None if present is None else set(present)
    if any(t is not None for t in times):
        for t in range(sizes.get("T", 1)):
            for c in range(sizes.get("C", 1)):
                for z in range(sizes.get("Z", 1)):
                    if there is not None and (t, c, z) not in there:
                        continue
                    known = t < len(times) and times[t] is not None
                    planes.append({"TheT": t, "TheC": c, "TheZ": z} | ({"DeltaT": times[t], "DeltaTUnit": "s"} if known else {}))
    names = [c.get("Name", "Channel") for c in meta.get("Channels") or []]
    return tiff.ome_xml(sizes, channels=names, planes=planes, description=json.dumps(extras) if extras else "", present=present, **pixels)


def _in_range(sizes: dict, place: tuple[int, int, int]) -> bool:
    return all(0 <= at < sizes.get(a, 1) for a, at in zip("TCZ", place, strict=True))


def _written_tiffs(compression: str, partial: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack = spool = writer = error = path = None

        def finished() -> pa.RecordBatch:
            size, why = 0, error or (f"{due} planes are missing" if due and not (partial and present) else None)
            if why is None:
                if due:
                    writer.describe(ome_description(meta, present))
                spool.seek(0)
                size = files.copy_to(path, spool)
            spool.close()
            return _results([(stack, path, why is None, size, why)])

        for batch in batches:
            for row in (r for i in range(0, batch.num_rows, 8) for r in batch.slice(i, 8).to_pylist()):
                if row["stack"] != stack:
                    if stack is not None:
                        yield finished()
                    stack, path, error, due, present, spool = row["stack"], row["path"], None, 0, [], tempfile.TemporaryFile()
                    try:
                        meta, writer = json.loads(row["meta"]), None
                        due = int(np.prod([meta["sizes"].get(a, 1) for a in "TCZ"]))
                    except (*tiff.BROKEN, OSError) as e:
                        error = str(e) or type(e).__name__
                error = error or row["error"]
                if row["px"] is None or error is not None:
                    continue
                try:
                    if due == 0:
                        raise ValueError("more planes than the metadata say")
                    place = (row["t"], row["c"], row["z"])
                    if partial and (place in present[-1:] or not _in_range(meta["sizes"], place)):
                        raise ValueError("planes twice, or where the metadata have none")
                    page = ops.pixels_of(row)
                    if writer is None:
                        meta["sizes"] |= {"Y": page.shape[0], "X": page.shape[1]}
                        writer = tiff.Writer(spool, compression, ome_description(meta))
                    elif page.shape != (meta["sizes"]["Y"], meta["sizes"]["X"]):
                        raise ValueError("planes of different sizes")
                    writer.add(page)
                    due -= 1
                    if partial:
                        present.append(place)
                except (*tiff.BROKEN, OSError) as e:
                    error = str(e) or type(e).__name__
        if stack is not None:
            yield finished()

    return run


def write_ome_tiffs(planes: DataFrame, meta: DataFrame, out_dir: str, compression: str = "lzw", partial: bool = False) -> DataFrame:
    """Write each stack as ``out_dir/stack.ome.tif`` and return (stack, path, success, size, error).

    ``planes``: (stack, t, c, z, h, w, px), and error where a plane couldn't be made; ``meta``: (stack, meta), JSON with ``sizes`` (T, C, Z) and the stack's metadata.  Planes
    come to a task sorted, stack by stack, and go to a local spool file one by one, so a task holds one plane however
    long the film is; the file is then published whole.  Evaluate the result once: that writes the files.

    A stack that lacks planes fails; with ``partial`` it is written if it has any, with the sizes of the metadata, and its
    TiffData say which plane each page is: t, c and z then count from 0.
    """
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    head = meta.select("stack", *[F.lit(-1).alias(k) for k in ("t", "c", "z")], none("int", "h"), none("int", "w"), none("binary", "px"), "meta", none("string", "error"))
    body = _with_error(planes).select(*ops.PLANE, none("string", "meta"), "error")
    path = F.concat(F.lit(out_dir.rstrip("/") + "/"), F.col("stack").cast("string"), F.lit(".ome.tif"))
    rows = head.unionByName(body).select(F.col("stack").cast("string").alias("stack"), path.alias("path"), "t", "c", "z", "h", "w", "px", "meta", "error")
    parts = int(planes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "stack").sortWithinPartitions("stack", "t", "c", "z").mapInArrow(_written_tiffs(compression, partial), RESULT)


def _with_error(planes: DataFrame) -> DataFrame:
    return planes if "error" in planes.columns else planes.withColumn("error", F.lit(None).cast("string"))


# OME-Zarr


def array_metadata(shape: Sequence[int], axes: str, dtype: str = "<u2") -> dict:
    """Array metadata of version 2: chunks of one plane's SIDE x SIDE, compressed by zstd."""
    chunks = [min(SIDE, n) if a in "YX" else 1 for a, n in zip(axes, shape, strict=True)]
    return {"zarr_format": 2, "shape": list(shape), "chunks": chunks, "dtype": dtype, "compressor": {"id": "zstd", "level": 3}, "fill_value": 0, "order": "C", "filters": None, "dimension_separator": "."}


def _chunks(page: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(row, column, compressed content) of a page's chunks; those at the edge are filled up."""
    h, w = min(SIDE, page.shape[0]), min(SIDE, page.shape[1])
    for y in range(0, page.shape[0], h):
        for x in range(0, page.shape[1], w):
            block = np.zeros((h, w), "<u2")
            part = page[y : y + h, x : x + w]
            block[: part.shape[0], : part.shape[1]] = part
            yield y // h, x // w, zstandard.ZstdCompressor(level=3).compress(block.tobytes())


def _written_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Writes a plane's chunks at all levels; says how often each value occurs at the coarsest one."""
    for batch in batches:
        for row in (r for i in range(0, batch.num_rows, 8) for r in batch.slice(i, 8).to_pylist()):
            size, error, values, counts = 0, row["error"], [], []
            try:
                if error is not None:
                    raise ValueError(error)
                page = ops.pixels_of(row)
                levels = ops.levels_of(*page.shape)
                kept, sides = [str(row[a.lower()]) for a in "TCZ" if a in row["axes"]], [n > 1 for n in page.shape]
                for level in range(levels):
                    part = page[:: 2**level, :: 2**level]
                    for y, x, data in _chunks(part):
                        places = [*kept, *([str(y)] if sides[0] else []), *([str(x)] if sides[1] else [])]
                        files.write_bytes(f"{row['path']}/{level}/{'.'.join(places)}", data)
                        size += len(data)
                values, counts = (a.tolist() for a in np.unique(part, return_counts=True))
            except (*tiff.BROKEN, OSError) as e:
                error = str(e) or type(e).__name__
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["stack"]]), pa.array([row["path"]]), *[pa.array([row[k]], pa.int32()) for k in "tcz"], pa.array([row["h"]], pa.int32()), pa.array([row["w"]], pa.int32()), pa.array([size], pa.int64()), pa.array([error], pa.string()), pa.array([values], pa.list_(pa.int32())), pa.array([counts], pa.list_(pa.int64()))],
                ["stack", "path", "t", "c", "z", "h", "w", "size", "error", "v", "n"],
            )


def zarr_attributes(meta: dict, axes: str, levels: int, windows: Sequence[tuple[float, float]], name: str) -> dict:
    """Attributes of a dataset: scales of its levels, channels with their display windows, and what else is known."""
    known = lambda k: float(meta.get(k) or 1.0)
    base = {"t": known("TimeIncrement"), "c": 1.0, "z": known("PhysicalSizeZ"), "y": known("PhysicalSizeY"), "x": known("PhysicalSizeX")}
    low = axes.lower()
    spec = [{k: v for k, v in zip(("name", "type", "unit"), (a, *ngff.AXES[a]), strict=True) if v} for a in low]
    scale = lambda k: [base[a] * (2**k if a in "yx" else 1) for a in low]
    channels = [
        {"label": c.get("Name", "Channel"), "color": "FFFFFF", "active": True, "window": {"min": 0.0, "max": 65535.0, "start": windows[i][0] if i < len(windows) else 0.0, "end": windows[i][1] if i < len(windows) else 65535.0}}
        for i, c in enumerate(meta.get("Channels") or [])
    ]
    return {
        "multiscales": [{"version": "0.4", "name": name, "axes": spec, "datasets": [{"path": str(k), "coordinateTransformations": [{"type": "scale", "scale": scale(k)}]} for k in range(levels)]}],
        "omero": {"version": "0.4", "channels": channels},
        EXTRAS: {k: v for k, v in meta.items() if k not in ngff.STANDARD and k != "sizes"},
    }


def _written_attributes(partial: bool):
    """Metadata come last: a folder without attributes is unfinished."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                error = row["error"] if row["planes"] else "no planes"
                try:
                    if error is None:
                        meta = json.loads(row["meta"])
                        sizes, path = meta["sizes"] | {"Y": row["h"], "X": row["w"]}, row["path"]
                        axes = "".join(a for a in "TCZYX" if sizes.get(a, 1) > 1)
                        if row["shapes"] > 1:
                            raise ValueError("planes of different sizes")
                        due = int(np.prod([sizes.get(a, 1) for a in "TCZ"]))
                        lacking = partial and row["planes"] < due
                        if row["planes"] != due and not lacking:
                            raise ValueError(f"{row['planes']} planes where the metadata say otherwise")
                        if partial and (row["places"] < row["planes"] or not all(_in_range(sizes, tuple(row["ends"][i])) for i in ("least", "most"))):
                            raise ValueError("planes twice, or where the metadata have none")
                        levels = ops.levels_of(sizes["Y"], sizes["X"])
                        for k in range(levels):
                            shape = [-(-sizes[a] // 2**k) if a in "YX" else sizes[a] for a in axes]
                            files.write_bytes(f"{path}/{k}/.zarray", json.dumps(array_metadata(shape, axes)).encode())
                        windows = [(w["lo"], w["hi"]) for w in sorted(row["windows"] or [], key=lambda w: w["c"])]
                        if lacking:
                            found = {w["c"]: (w["lo"], w["hi"]) for w in row["windows"]}
                            windows, meta[STORED] = [found.get(c, (0.0, 65535.0)) for c in range(sizes.get("C", 1))], row["planes"]
                        files.write_bytes(f"{path}/.zgroup", b'{"zarr_format": 2}')
                        name = path.rpartition("/")[2].removesuffix(".zarr")
                        files.write_bytes(f"{path}/.zattrs", json.dumps(zarr_attributes(meta, axes, levels, windows, name)).encode())
                    else:
                        files.remove(row["path"])
                except (*tiff.BROKEN, OSError) as e:
                    error = str(e) or type(e).__name__
                rows.append((row["stack"], row["path"], error is None, row["size"] or 0, error))
            yield _results(rows)

    return run


def write_ome_zarrs(planes: DataFrame, meta: DataFrame, out_dir: str, materialize, partial: bool = False) -> DataFrame:
    """Write each stack as ``out_dir/stack.ome.zarr`` and return (stack, path, success, size, error).

    Planes are written where they are, each by itself, so one large stack is spread over all tasks; only counted values
    of the coarsest level are gathered, for exact display windows by channel.  ``materialize`` fixes the planes' results:
    it is called with (DataFrame, name), writes the chunks, and gives what it has written.

    A stack that lacks planes fails; with ``partial`` it is written if it has any, with the sizes of the metadata, and its own
    metadata say how many it has (STORED): t, c and z then count from 0.
    """
    sizes = F.from_json(F.get_json_object("meta", "$.sizes"), "map<string,int>")
    size = lambda a: F.coalesce(F.try_element_at(sizes, F.lit(a)), F.lit(1))
    axes = ngff.squeezed_axes(size("T"), size("C"), size("Z"), F.lit(1), F.lit(1))
    path = F.concat(F.lit(out_dir.rstrip("/") + "/"), F.col("stack").cast("string"), F.lit(".ome.zarr"))
    known = meta.select(F.col("stack").cast("string").alias("stack"), path.alias("path"), axes.alias("axes"), "meta")
    rows = _with_error(planes).withColumn("stack", F.col("stack").cast("string")).join(known.select("stack", "path", "axes"), "stack")
    done = materialize(rows.mapInArrow(_written_chunks, "stack string, path string, t int, c int, z int, h int, w int, size long, error string, v array<int>, n array<long>"), "zarr-chunks")
    counts = done.select("stack", "c", F.explode(F.arrays_zip("v", "n")).alias("x")).groupBy("stack", "c", F.col("x.v").alias("v")).agg(F.sum("x.n").alias("n"))
    window = counts.groupBy("stack", "c").agg(F.percentile("v", F.lit(0.01), F.col("n")).alias("lo"), F.percentile("v", F.lit(0.99), F.col("n")).alias("hi"))
    windows = window.groupBy("stack").agg(F.collect_list(F.struct("c", "lo", "hi")).alias("windows"))
    whole = done.groupBy("stack").agg(
        F.sum("size").alias("size"), F.max("error").alias("error"), F.count("*").alias("planes"), F.max("h").alias("h"), F.max("w").alias("w"), F.countDistinct("h", "w").alias("shapes"),
        F.countDistinct("t", "c", "z").alias("places"), F.struct(*[F.array(*[f(k) for k in "tcz"]).alias(n) for n, f in (("least", F.min), ("most", F.max))]).alias("ends"),
    )
    return known.join(whole, "stack", "left").join(windows, "stack", "left").mapInArrow(_written_attributes(partial), RESULT)


def read_zarr_planes(spark: SparkSession, path: str, level: int = 0) -> DataFrame:
    """(t, c, z, h, w, px) of a level of a dataset: its planes put together from their chunks, one task a plane.

    A dataset whose own metadata say that it lacks planes has rows for those it has; any other chunk that is missing is an error.
    """
    meta = json.loads(files.read_bytes(f"{path}/{level}/.zarray"))
    attrs = json.loads(files.read_bytes(f"{path}/.zattrs"))
    axes = "".join(a["name"] for a in attrs["multiscales"][0]["axes"]).upper()
    sizes = dict(zip(axes, meta["shape"], strict=True))
    chunk = dict(zip(axes, meta["chunks"], strict=True))
    lacking = STORED in attrs.get(EXTRAS, {})
    h, w, ch, cw = sizes.get("Y", 1), sizes.get("X", 1), chunk.get("Y", 1), chunk.get("X", 1)

    def run(row: dict) -> list[dict]:
        out, names = np.zeros((-(-h // ch) * ch, -(-w // cw) * cw), "<u2"), {}
        for y in range(0, h, ch):
            for x in range(0, w, cw):
                places = [*[str(row[a.lower()]) for a in "TCZ" if a in axes], *([str(y // ch)] if "Y" in axes else []), *([str(x // cw)] if "X" in axes else [])]
                names[y, x] = f"{path}/{level}/{'.'.join(places)}"
        if lacking and not any(files.exists(name) for name in names.values()):
            return []
        for (y, x), name in names.items():
            raw = zstandard.ZstdDecompressor().decompress(files.read_bytes(name))
            out[y : y + ch, x : x + cw] = np.frombuffer(raw, "<u2").reshape(ch, cw)
        return [row | {"h": h, "w": w, "px": out[:h, :w].tobytes()}]

    axis = lambda a: F.explode(F.sequence(F.lit(0), F.lit(sizes.get(a, 1) - 1)))
    keys = spark.range(1).select(axis("T").alias("t")).select("t", axis("C").alias("c")).select("t", "c", axis("Z").alias("z"))
    return ops.each_plane(keys.repartition(max(1, min(200, sizes.get("T", 1)))), run, "t int, c int, z int, h int, w int, px binary")
