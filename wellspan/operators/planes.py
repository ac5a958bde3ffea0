"""Image operators over planes: a row per plane (stack, t, c, z, h, w, px), never a row per pixel.

``px`` holds little-endian pixels row by row, 16 bits each unless an operator says otherwise.  Stacks are told apart by
``stack``, of any type; further columns an operator needs are named in its docstring.  Work that needs one plane runs
where the plane is (``mapInArrow``); work over several planes brings those of one frame and channel to a task
(``applyInArrow``), so what a task holds is one Z stack or one mosaic, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLANE = ("stack", "t", "c", "z", "h", "w", "px")
#: Planes that one Arrow batch passes on at most, and bytes of references that are sent to every task.
BATCH_PLANES, BROADCAST_BYTES = 8, 256 << 20
#: Tasks over which the planes of one reference are spread where references are too large to be sent everywhere.
SALTS = 32
TOP = 65535


def pixels_of(row: dict, kind: str = "<u2") -> np.ndarray:
    return np.frombuffer(row["px"], kind).reshape(row["h"], row["w"])


def _filled(page: np.ndarray, kind: str = "<u2") -> dict:
    return {"h": page.shape[0], "w": page.shape[1], "px": np.ascontiguousarray(page.astype(kind)).tobytes()}


def _schema(df: DataFrame, **columns: str) -> str:
    """DDL of ``df``'s columns with some replaced, added or (None) left out."""
    have = {n: columns.get(n, t) for n, t in df.dtypes} | columns
    return ", ".join(f"`{n}` {t}" for n, t in have.items() if t)


def each_plane(df: DataFrame, run: Callable[[dict], list[dict]], schema: str) -> DataFrame:
    """Rows made of each row by itself, a few planes at a time."""
    names, types = _names(schema), _arrow(schema)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_PLANES):
                rows = [out for row in batch.slice(at, BATCH_PLANES).to_pylist() for out in run(row)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types, strict=True)], names)

    return df.mapInArrow(mapped, schema)


def each_group(df: DataFrame, keys: Sequence[str], run: Callable[[list[dict]], list[dict]], schema: str) -> DataFrame:
    """Rows made of the rows of each key together."""
    names, types = _names(schema), _arrow(schema)

    def grouped(table: pa.Table) -> pa.Table:
        rows = run(table.to_pylist())
        return pa.Table.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types, strict=True)], names)

    return df.groupBy(*keys).applyInArrow(grouped, schema)


def _names(schema: str) -> list[str]:
    return [f.name for f in _struct(schema).fields]


def _struct(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def _arrow(schema: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in _struct(schema).fields]


# Pixels as rows, for SQL


def exploded(planes: DataFrame, *keys: str) -> DataFrame:
    """(keys, y, x, v): a row per pixel, for results that SQL is to read; no operator works on it."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                h, w = one.column(len(keys))[0].as_py(), one.column(len(keys) + 1)[0].as_py()
                v = np.frombuffer(one.column(len(keys) + 2)[0].as_buffer(), "<u2").astype(np.int32)
                y, x = np.divmod(np.arange(h * w, dtype=np.int32), np.int32(w))
                same = pa.array(np.zeros(h * w, np.int32))
                yield pa.RecordBatch.from_arrays([*[one.column(i).take(same) for i in range(len(keys))], pa.array(y), pa.array(x), pa.array(v)], [*keys, "y", "x", "v"])

    rows = planes.select(*keys, "h", "w", "px")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(mapped, ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "y int", "x int", "v int"]))


# Sums over planes


def plane_sums(planes: DataFrame) -> DataFrame:
    """Planes' other columns with s (sum) and n (pixels) in place of px."""

    def run(row: dict) -> list[dict]:
        return [row | {"s": int(pixels_of(row).sum(dtype=np.int64)), "n": row["h"] * row["w"]}]

    return each_plane(planes, run, _schema(planes, px=None, s="long", n="long"))


def mean_planes(planes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, h, w, px): the mean of the planes of each key, rounded down.  Each task adds up its planes before any are sent."""
    kinds = dict(planes.dtypes)
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "h int", "w int", "px binary", "n long"])
    names, types = [*keys, "h", "w", "px", "n"], _arrow(schema)

    def total(rows: list[tuple[tuple, np.ndarray, int]]) -> dict[tuple, list]:
        sums: dict[tuple, list] = {}
        for key, page, n in rows:
            have = sums.setdefault((*key, *page.shape), [np.zeros(page.shape, np.int64), 0])
            have[0] += page
            have[1] += n
        return sums

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                for key, (page, n) in total([(tuple(row[k] for k in keys), pixels_of(row).astype(np.int64), 1)]).items():
                    have = sums.setdefault(key, [np.zeros(page.shape, np.int64), 0])
                    have[0] += page
                    have[1] += n
        rows = [(*key, page.astype("<i8").tobytes(), n) for key, (page, n) in sums.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    def final(rows: list[dict]) -> list[dict]:
        sums = total([(tuple(r[k] for k in keys), pixels_of(r, "<i8"), r["n"]) for r in rows])
        return [dict(zip(keys, key, strict=False)) | _filled(page // n) for key, (page, n) in sums.items()]

    summed = planes.select(*keys, "h", "w", "px").mapInArrow(partial, schema)
    return each_group(summed, [*keys], final, ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "h int", "w int", "px binary"]))


# Correction


def references(dark: DataFrame, flat: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, dark, gain) of dark and flat planes (keys, h, w, px): gain = mean(flat - dark) / (flat - dark), 0 where that is infinite.

    Keys without both planes, or with planes of different shapes, have no row, so their images stay uncorrected.
    """
    both = dark.select(*keys, "h", "w", F.col("px").alias("dark")).join(flat.select(*keys, "h", "w", F.col("px").alias("flat")), [*keys, "h", "w"])

    def run(row: dict) -> list[dict]:
        dark, flat = (np.frombuffer(row[k], "<u2") for k in ("dark", "flat"))
        return [row | {"gain": gain_of(dark, flat).astype("<f8").tobytes()}]

    return each_plane(both, run, _schema(both, flat=None, h=None, w=None, gain="binary"))


def gain_of(dark: np.ndarray, flat: np.ndarray) -> np.ndarray:
    ff = flat.astype(float) - dark
    return np.divide(ff.mean(), ff, out=np.zeros(ff.shape), where=ff != 0)


def evened(page: np.ndarray, dark: np.ndarray, gain: np.ndarray) -> np.ndarray:
    return np.clip((page.astype(float) - dark) * gain, 0, TOP).astype(np.uint16)


def correct(planes: DataFrame, refs: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Planes with (v - dark) * gain, cut to 0..65535 and truncated; planes without a reference, or not in ``where``, stay as they are.

    References go to every task if BROADCAST_BYTES hold them all; else planes meet them by a shuffle, where each
    reference is sent to SALTS tasks, so one camera's planes are spread.
    """
    size = refs.agg(F.sum(F.length("dark") + F.length("gain"))).first()[0] or 0
    names = [f"_ref_{k}" for k in keys]
    refs = refs.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], "dark", "gain")
    on = F.lit(True) if where is None else where
    for k, n in zip(keys, names, strict=True):
        on &= F.col(k) == F.col(n)
    if size <= BROADCAST_BYTES:
        joined = planes.join(F.broadcast(refs), on, "left")
    else:
        refs = refs.withColumn("_salt_ref", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("stack", "t", "z"), F.lit(SALTS)).cast("int")
        joined = planes.withColumn("_salt", salt).join(refs, on & (F.col("_salt") == F.col("_salt_ref")), "left").drop("_salt", "_salt_ref")

    def run(row: dict) -> list[dict]:
        if row["gain"] is not None and len(row["gain"]) == 4 * len(row["px"]):
            dark = np.frombuffer(row["dark"], "<u2").reshape(row["h"], row["w"])
            gain = np.frombuffer(row["gain"], "<f8").reshape(row["h"], row["w"])
            row |= _filled(evened(pixels_of(row), dark, gain))
        return [row]

    return each_plane(joined.drop(*names), run, _schema(planes))


# Projections over Z


def largest(pages: Sequence[np.ndarray]) -> np.ndarray:
    out = pages[0].copy()
    for page in pages[1:]:
        np.maximum(out, page, out=out)
    return out


def project_max(planes: DataFrame) -> DataFrame:
    """(stack, t, c, z = 0, h, w, px): the maximum over Z of each pixel."""

    def run(rows: list[dict]) -> list[dict]:
        return [rows[0] | {"z": 0} | _filled(largest([pixels_of(r) for r in rows]))]

    planes = planes.select(*PLANE)
    return each_group(planes, ["stack", "t", "c"], run, _schema(planes))


def brightest_z(planes: DataFrame) -> DataFrame:
    """(stack, z): the slice of each stack with the largest mean over all its frames and channels, the lowest on ties."""
    means = plane_sums(planes.select(*PLANE)).groupBy("stack", "z").agg((F.sum("s") / F.sum("n")).alias("mean"))
    order = Window.partitionBy("stack").orderBy(F.desc("mean"), "z")
    return means.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").select("stack", "z")


def project_brightest(planes: DataFrame) -> DataFrame:
    """The planes of each stack's brightest slice; other planes are dropped before anything else is done with them."""
    return planes.join(brightest_z(planes), ["stack", "z"], "left_semi").select(*PLANE)


def entropy(page: np.ndarray) -> float:
    """-sum d log2 d over 256 equal bins of the plane's range, d the density; the last bin is closed, a constant plane's range is v ± 0.5."""
    lo, hi = float(page.min()), float(page.max())
    lo, span = (lo - 0.5, 1.0) if lo == hi else (lo, hi - lo)
    k = np.bincount(np.minimum(255, np.floor((page.astype(float) - lo) * 256 / span)).astype(np.int64).ravel(), minlength=256)
    d = k[k > 0] / (page.size * span / 256)
    return float(-(d * np.log2(d)).sum())


def entropies(planes: DataFrame) -> DataFrame:
    """Planes' other columns with their entropy in place of px."""
    return each_plane(planes, lambda row: [row | {"entropy": entropy(pixels_of(row))}], _schema(planes, px=None, entropy="double"))


def project_entropy(planes: DataFrame, most: bool = True) -> DataFrame:
    """Per (stack, t, c) the slice with the largest (or least) entropy, rounded to 9 digits, lowest z on ties."""
    e = F.round("entropy", 9)
    order = Window.partitionBy("stack", "t", "c").orderBy(e.desc() if most else e.asc(), "z")
    best = entropies(planes.select(*PLANE)).withColumn("_rank", F.row_number().over(order)).where("_rank = 1")
    return planes.join(best.select("stack", "t", "c", "z"), ["stack", "t", "c", "z"], "left_semi").select(*PLANE)


def _padded(a: np.ndarray, n: int, axis: int) -> np.ndarray:
    return np.pad(a, [(n, n) if i == axis else (0, 0) for i in range(a.ndim)], mode="symmetric")


def _along(a: np.ndarray, weights: Sequence[float], axis: int) -> np.ndarray:
    """Correlation along an axis, edges mirrored with the edge pixel repeated."""
    n, size = len(weights) // 2, a.shape[axis]
    wide = _padded(a, n, axis)
    return sum(w * np.take(wide, np.arange(i, i + size), axis) for i, w in enumerate(weights))


def sharpness(page: np.ndarray, sigma: float = 2.0) -> np.ndarray:
    """Tenengrad focus of each pixel: squared Sobel gradient, smoothed by a Gaussian (of radius 4 sigma) if sigma is above 0."""
    a = page.astype(float)
    m = sum(_along(_along(a, [-1, 0, 1], axis), [1, 2, 1], 1 - axis) ** 2 for axis in (0, 1))
    if sigma > 0:
        radius = int(4 * sigma + 0.5)
        weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
        for axis in (0, 1):
            m = _along(m, weights / weights.sum(), axis)
    return m


def focused(pages: Sequence[np.ndarray], sigma: float = 2.0, digits: int | None = None) -> np.ndarray:
    """The mean of pages weighed by each pixel's share of focus."""
    focus = [sharpness(page, sigma) for page in pages]
    total = sum(focus) + 1e-9
    mean = sum(page * (f / total) for page, f in zip(pages, focus, strict=True))
    return np.clip(mean if digits is None else np.round(mean, digits), 0, TOP)


def project_focus(planes: DataFrame, sigma: float = 2.0, digits: int | None = None) -> DataFrame:
    """(stack, t, c, z = 0, h, w, px): the mean over Z weighed by each pixel's share of focus, cut and truncated.

    With ``digits`` values are rounded to so many digits first, so that two engines truncate alike.
    """

    def run(rows: list[dict]) -> list[dict]:
        pages = [pixels_of(r) for r in sorted(rows, key=lambda r: r["z"])]
        return [rows[0] | {"z": 0} | _filled(focused(pages, sigma, digits))]

    planes = planes.select(*PLANE)
    return each_group(planes, ["stack", "t", "c"], run, _schema(planes))


MODES = ("keep", "mip", "maxz", "osbm", "max_entropy", "min_entropy")


def project(planes: DataFrame, mode: str) -> DataFrame:
    """Planes projected over Z by a mode of MODES; ``keep`` changes nothing."""
    match mode:
        case "keep":
            return planes.select(*PLANE)
        case "mip":
            return project_max(planes)
        case "maxz":
            return project_brightest(planes)
        case "osbm":
            return project_focus(planes)
        case "max_entropy" | "min_entropy":
            return project_entropy(planes, mode == "max_entropy")
    raise ValueError(f"z mode must be one of {', '.join(MODES)}, not {mode!r}")


# Mosaics


def feather(size: int, overlap: int) -> np.ndarray:
    """Ramp (i + 1) / (overlap + 1) at each edge, 1 between; the far edge overwrites where they meet."""
    out = np.ones(size)
    ramp = (np.arange(min(overlap, size)) + 1) / (overlap + 1)
    out[: len(ramp)] = ramp
    if len(ramp):
        out[-len(ramp) :] = ramp[::-1]
    return out


def mosaic(tiles: Sequence[tuple[int, int, np.ndarray]], rows: int, cols: int, overlap: int, digits: int = 6) -> np.ndarray:
    """The feathered mosaic of tiles (gy, gx, page) on a grid of rows x cols; equal tiles give what they hold, whatever the weights."""
    h, w = tiles[0][2].shape
    dy, dx = max(h - overlap, 1), max(w - overlap, 1)
    weight = feather(h, overlap)[:, None] * feather(w, overlap)
    total = np.zeros(((rows - 1) * dy + h, (cols - 1) * dx + w))
    mass = np.zeros(total.shape)
    for gy, gx, page in sorted(tiles, key=lambda t: t[:2]):
        at = slice(gy * dy, gy * dy + h), slice(gx * dx, gx * dx + w)
        total[at] += page * weight
        mass[at] += weight
    mean = total / np.maximum(mass, 1e-9)
    return np.clip(np.round(mean, digits), 0, TOP)


def stitch(tiles: DataFrame, digits: int = 6) -> DataFrame:
    """(stack, t, c, z, h, w, px): feathered mosaics of tiles with columns gy, gx, overlap besides those of planes.

    Tiles stand at steps of size - overlap; weights are added up, pixels no tile covers are 0; the mosaic of a frame is as
    large as its stack's grid.  Values are rounded to ``digits`` digits before they are truncated.
    """
    grid = tiles.groupBy("stack").agg((F.max("gy") + 1).alias("rows"), (F.max("gx") + 1).alias("cols"))
    placed = tiles.select(*PLANE, "gy", "gx", "overlap").join(grid, "stack")

    def run(rows: list[dict]) -> list[dict]:
        first = rows[0]
        return [first | _filled(mosaic([(r["gy"], r["gx"], pixels_of(r)) for r in rows], first["rows"], first["cols"], first["overlap"], digits))]

    planes = tiles.select(*PLANE)
    return each_group(placed, ["stack", "t", "c", "z"], run, _schema(planes))


# Sizes and contrast


def decimate(planes: DataFrame, level: int) -> DataFrame:
    """Every 2**level-th pixel along Y and X."""
    step = 2**level
    return each_plane(planes, lambda row: [row | _filled(pixels_of(row)[::step, ::step])], _schema(planes))


def levels_of(height: int, width: int, most: int = 4, least: int = 16) -> int:
    """Pyramid levels until an axis would fall under ``least`` pixels, at least one."""
    levels = 1
    while levels < most and height >> levels >= least and width >> levels >= least:
        levels += 1
    return levels


def pyramid(planes: DataFrame, most: int = 4, least: int = 16) -> DataFrame:
    """All levels of each plane, with ``level``; a plane is decoded once."""

    def run(row: dict) -> list[dict]:
        page = pixels_of(row)
        return [row | {"level": k} | _filled(page[:: 2**k, :: 2**k]) for k in range(levels_of(*page.shape, most, least))]

    return each_plane(planes, run, _schema(planes, level="int"))


def block_mean(planes: DataFrame, k: int) -> DataFrame:
    """Mean of k x k blocks, the remainder cropped, truncated."""

    def run(row: dict) -> list[dict]:
        page = pixels_of(row)
        h, w = page.shape[0] // k, page.shape[1] // k
        return [row | _filled(page[: h * k, : w * k].reshape(h, k, w, k).mean(axis=(1, 3)))]

    return each_plane(planes, run, _schema(planes))


def value_counts(planes: DataFrame, keys: Sequence[str] = ("stack", "c")) -> DataFrame:
    """(keys, v, n): how often each value occurs; tasks count their planes before anything is sent."""
    planes = planes.select(*keys, "h", "w", "px")

    def run(row: dict) -> list[dict]:
        v, n = np.unique(pixels_of(row), return_counts=True)
        return [{k: row[k] for k in keys} | {"v": a, "n": b} for a, b in zip(v.tolist(), n.tolist(), strict=True)]

    counts = each_plane(planes, run, _schema(planes, h=None, w=None, px=None, v="int", n="long"))
    return counts.groupBy(*keys, "v").agg(F.sum("n").alias("n"))


def display_window(planes: DataFrame, keys: Sequence[str] = ("stack", "c"), low: float = 0.01, high: float = 0.99) -> DataFrame:
    """(keys, lo, hi): exact percentiles (linear between neighbours), rounded to 6 digits, from counted values."""
    counts = value_counts(planes, keys)
    return counts.groupBy(*keys).agg(F.round(F.percentile("v", F.lit(low), F.col("n")), 6).alias("lo"), F.round(F.percentile("v", F.lit(high), F.col("n")), 6).alias("hi"))


def stretch8(planes: DataFrame, window: DataFrame, keys: Sequence[str] = ("stack", "c"), digits: int | None = None) -> DataFrame:
    """Planes of values 0..255 (still 16 bits each): contrast stretched between the key's lo and hi, truncated."""
    joined = planes.join(window.select(*keys, "lo", "hi"), [*keys])

    def run(row: dict) -> list[dict]:
        v = np.clip((pixels_of(row) - row["lo"]) / max(row["hi"] - row["lo"], 1.0) * 255, 0, 255)
        return [row | _filled(v if digits is None else np.round(v, digits))]

    return each_plane(joined, run, _schema(planes)).select(*planes.columns)


def valid_frames(planes: DataFrame, keys: Sequence[str] = ("stack",)) -> DataFrame:
    """Planes that have the shape of their key's first plane (least t, c, z); shapes are compared, not pixels."""
    first = planes.groupBy(*keys).agg(F.min_by(F.struct("h", "w"), F.struct("t", "c", "z")).alias("_shape"))
    return planes.join(first, [*keys]).where((F.col("h") == F.col("_shape.h")) & (F.col("w") == F.col("_shape.w"))).select(*planes.columns)


def stack_shapes(planes: DataFrame) -> DataFrame:
    """(stack, size_t, size_c, size_z, h, w) from planes' keys alone."""
    return planes.groupBy("stack").agg(*[F.countDistinct(k).alias(f"size_{k}") for k in ("t", "c", "z")], F.max("h").alias("h"), F.max("w").alias("w"))
