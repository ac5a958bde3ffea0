"""The main plan: measurement directories to calibrated image stacks, written as OME-TIFF or OME-Zarr.

Metadata are planned by Catalyst; pixels are read in one place only, per frame and channel: a task decodes the planes of
that Z stack (or mosaic), corrects them, stitches and projects.  What is shuffled before that are paths.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import basename, well_id
from ..functions.times import text_seconds
from ..operators import planes as ops
from ..operators import records
from ..scratch import materialize
from ..sinks.images import write_ome_tiffs, write_ome_zarrs
from ..sources import files, tiff
from ..sources.measurements import Measurements, read_measurements

FORMATS = ("tiff", "zarr", "both")
FRAME = "stack string, t int, c int, z int, h int, w int, px binary, error string"


@lru_cache(maxsize=8)
def _reference(dark: str, flat: str) -> tuple[np.ndarray, np.ndarray]:
    d, f = (tiff.decode(files.read_bytes(p)) for p in (dark, flat))
    return d.astype(float), ops.gain_of(d, f)


def _pages(rows: Sequence[dict]) -> dict[int, np.ndarray]:
    """The pages of a frame and channel by z: decoded, corrected, stitched where they are tiles."""
    tiles: dict[int, list] = {}
    for row in rows:
        page = tiff.decode(files.read_bytes(row["tif_path"]))
        if row["dark_path"] is not None and row["flat_path"] is not None:
            dark, gain = _reference(row["dark_path"], row["flat_path"])
            page = ops.evened(page, dark, gain)
        tiles.setdefault(row["z"], []).append((row["gy"], row["gx"], page))
    if rows[0]["kind"] != "tile":
        return {z: found[0][2] for z, found in sorted(tiles.items())}
    return {z: ops.mosaic(found, rows[0]["rows"], rows[0]["cols"], rows[0]["overlap"]).astype(np.uint16) for z, found in sorted(tiles.items())}


def _projected(pages: dict[int, np.ndarray], mode: str) -> dict[int, np.ndarray]:
    match mode:
        case "mip":
            return {0: ops.largest(list(pages.values()))}
        case "osbm":
            return {0: ops.focused(list(pages.values())).astype(np.uint16)}
        case "max_entropy" | "min_entropy":
            sign = -1 if mode == "max_entropy" else 1
            best = min(pages, key=lambda z: (sign * round(ops.entropy(pages[z]), 9), z))
            return {0: pages[best]}
    return pages


def _frames(rows: list[dict]) -> list[dict]:
    """Planes of one frame and channel; a row with an error, and no pixels, where they can't be made."""
    key = {k: rows[0][k] for k in ("stack", "t", "c")}
    try:
        if len({(r["z"], r["gy"], r["gx"]) for r in rows}) != len(rows):
            raise ValueError("two planes in one place")
        mode = rows[0]["mode"]
        out = _projected(_pages(rows), mode)
        out = {0: page for page in out.values()} if mode == "maxz" else out
        return [key | {"z": z, "h": page.shape[0], "w": page.shape[1], "px": np.ascontiguousarray(page.astype("<u2")).tobytes()} for z, page in out.items()]
    except (*tiff.BROKEN, OSError) as e:
        return [key | {"z": 0, "error": str(e) or type(e).__name__}]


def _means(rows: list[dict]) -> list[dict]:
    """Sum and size of each slice of one frame and channel; none where they can't be made (the planes then say why)."""
    try:
        return [{"stack": rows[0]["stack"], "z": z, "s": int(page.sum(dtype=np.int64)), "n": page.size} for z, page in _pages(rows).items()]
    except (*tiff.BROKEN, OSError):
        return []


def assembled(planes: DataFrame) -> DataFrame:
    """(stack, t, c, z, h, w, px, error) of plane rows with paths, positions, corrections and the stack's ``mode``.

    With ``maxz`` the stack's brightest slice is found first; then only its files are read.
    """
    brightest = planes.where("mode = 'maxz'")
    sums = ops.each_group(brightest, ["stack", "t", "c"], _means, "stack string, z int, s long, n long")
    best = sums.groupBy("stack", "z").agg((F.sum("s") / F.sum("n")).alias("mean"))
    best = best.groupBy("stack").agg(F.min_by("z", F.struct(-F.col("mean"), "z")).alias("best"))
    kept = planes.join(best, "stack", "left").where((F.col("mode") != "maxz") | F.col("best").isNull() | (F.col("z") == F.col("best"))).drop("best")
    return ops.each_group(kept, ["stack", "t", "c"], _frames, FRAME)


def channels_of(acquisitions: DataFrame) -> DataFrame:
    """(acquisition, ch, pixel_x, pixel_y, camera, shading): channels as measured, by number."""
    rows = acquisitions.select(F.col("acquisition_index").alias("acquisition"), F.explode("measurement_channel").alias("m"))
    return rows.select(
        "acquisition", F.col("m.ch").alias("ch"), F.col("m.horizontal_pixel_dimension").alias("pixel_x"), F.col("m.vertical_pixel_dimension").alias("pixel_y"),
        F.col("m.camera_number").alias("camera"), F.nullif(F.col("m.shading_correction_source"), F.lit("")).alias("shading"),
    ).dropDuplicates(["acquisition", "ch"])


def channel_settings(acquisitions: DataFrame) -> DataFrame:
    """(acquisition, ch, listed, magnification, objective, exposure_time, acquisition_name, method, fluorophore)."""
    rows = acquisitions.select(F.col("acquisition_index").alias("acquisition"), F.explode("setting.channel_list.channel").alias("s"))
    names = ("magnification", "objective", "exposure_time", "method", "fluorophore")
    return rows.select("acquisition", F.col("s.ch").alias("ch"), F.lit(True).alias("listed"), F.col("s.acquisition").alias("acquisition_name"), *[F.col(f"s.{n}").alias(n) for n in names]).dropDuplicates(["acquisition", "ch"])


def correction_paths(rec: DataFrame, channels: DataFrame, listing: DataFrame) -> DataFrame:
    """(acquisition, ch, dark_path, flat_path) where both files lie beside the acquisition's images; others have no row."""
    folder = rec.groupBy("acquisition").agg(F.min("tif_path").alias("first")).select("acquisition", F.regexp_replace("first", "/[^/]+$", "").alias("folder"))
    wanted = channels.where("shading IS NOT NULL AND camera IS NOT NULL").join(folder, "acquisition")
    wanted = wanted.select("acquisition", "ch", F.concat("folder", F.format_string("/DC_DCAM#%d_CAM%d.tif", "camera", "camera")).alias("dark_path"), F.concat("folder", F.lit("/"), "shading").alias("flat_path"))
    there = lambda c: listing.select(F.col("path").alias(c))
    return wanted.join(there("dark_path"), "dark_path", "left_semi").join(there("flat_path"), "flat_path", "left_semi").select("acquisition", "ch", "dark_path", "flat_path")


def stack_names(keyed: DataFrame, settings: DataFrame, title: str | None) -> DataFrame:
    """(stack keys, first_acquisition, stack): the name of each stack, with the magnification of its first channel."""
    first = keyed.groupBy(*records.STACK).agg(F.min(F.struct("acquisition", "ch")).alias("f"), F.min("ch").alias("first_ch"))
    first = first.select(*records.STACK, F.col("f.acquisition").alias("acquisition"), F.col("first_ch").alias("ch"))
    known = first.join(settings.select("acquisition", "ch", "listed", "magnification"), ["acquisition", "ch"], "left")
    power = F.when(F.col("listed"), F.col("magnification")).otherwise(F.lit(0))
    name = basename(F.lit(title), F.col("row"), F.col("column"), F.col("kind"), F.col("position"), F.col("timeline_index"), F.col("action_index"), F.col("action"), power, F.col("split_acq"))
    return known.select(*records.STACK, F.col("acquisition").alias("first_acquisition"), name.alias("stack"))


def stack_metadata(placed: DataFrame, names: DataFrame, acquisitions: DataFrame, mode: Column) -> DataFrame:
    """(stack, meta): what is known of each stack, as JSON; a field that isn't known is left out."""
    settings, channels = channel_settings(acquisitions), channels_of(acquisitions)
    used = placed.select("stack", "first_acquisition", "ch").distinct().withColumnRenamed("first_acquisition", "acquisition")
    listed = used.join(settings, ["acquisition", "ch"], "left")
    entry = F.struct(
        F.col("ch"), F.struct(
            F.concat(F.lit("Channel_"), F.col("ch").cast("string")).alias("Name"), F.col("magnification").alias("Magnification"), F.col("objective").alias("Objective"), F.col("exposure_time").alias("ExposureTime"),
            F.col("acquisition_name").alias("Acquisition"), F.col("method").alias("Method"), F.col("fluorophore").alias("Fluorophore"),
        ).alias("entry"),
    )
    of_channels = listed.groupBy("stack").agg(F.array_sort(F.collect_list(entry)).alias("all")).select("stack", F.col("all.entry").alias("Channels"))
    sizes = records.pixel_sizes(used.join(channels, ["acquisition", "ch"]), ["stack"])
    frames = placed.groupBy("stack", "t").agg(F.min("time").alias("time")).withColumn("s", text_seconds(F.col("time")))
    times = records.time_metadata(records.frame_times(frames, ["stack"], ["t"]), ["stack"], ["t"])
    stamps = frames.groupBy("stack").agg(F.array_sort(F.collect_list(F.struct("t", "time"))).alias("all")).select("stack", F.col("all.time").alias("Timestamps"))
    shape = placed.groupBy("stack").agg((F.max("t") + 1).alias("T"), (F.max("c") + 1).alias("C"), (F.max("z") + 1).alias("depth"), F.max("rows").alias("rows"), F.max("cols").alias("cols"))
    timeline = records.timeline_at(F.col("setting.timelapse.timeline"), F.col("timeline_index"))
    of_acq = acquisitions.select(F.col("acquisition_index").alias("first_acquisition"), "operator_name", F.col("well_plate.name").alias("plate"), "setting")
    rows = names.join(of_acq, "first_acquisition", "left").join(shape, "stack")
    for other in (of_channels, sizes, times, stamps):
        rows = rows.join(other, "stack", "left")
    tiled = F.col("kind") == "tile"
    if_tiled = lambda c: F.when(tiled, c)
    depth = F.when(mode == "keep", F.col("depth")).otherwise(1)
    meta = F.struct(
        F.create_map(F.lit("T"), F.col("T"), F.lit("C"), F.col("C"), F.lit("Z"), depth).alias("sizes"),
        F.coalesce("size_y", F.lit(1.0)).alias("PhysicalSizeY"), F.coalesce("size_x", F.lit(1.0)).alias("PhysicalSizeX"), F.lit("µm").alias("PhysicalSizeYUnit"), F.lit("µm").alias("PhysicalSizeXUnit"),
        "Channels", F.col("plate").alias("PlateType"), F.col("operator_name").alias("Operator"), "Timestamps", well_id(F.col("row"), F.col("column")).alias("WellID"),
        F.col("action_index").alias("ActionIndex"), F.col("action").alias("Action"), mode.alias("ZMode"),
        if_tiled(F.col("position")).alias("PartialTileIndex"), if_tiled(F.lit(True)).alias("Stitched"), if_tiled(F.col("cols")).alias("TileGridX"), if_tiled(F.col("rows")).alias("TileGridY"),
        F.when(~tiled, F.col("position")).alias("FieldIndex"), F.col("split_acq").alias("AcquisitionIndex"), F.when(F.col("split_acq").isNotNull(), F.lit(False)).alias("MergedAcquisitions"),
        timeline["name"].alias("TimelineName"), timeline["period"].alias("TimelinePeriod"), timeline["interval"].alias("TimelineInterval"), timeline["expected_time"].alias("TimelineExpectedTime"),
        F.col("relative_times").alias("RelativeTimes"), F.when(F.col("relative_times").isNotNull(), "s").alias("RelativeTimesUnit"), F.col("frame_intervals").alias("FrameIntervals"),
        F.col("time_increment").alias("TimeIncrement"), F.when(F.col("time_increment").isNotNull(), "s").alias("TimeIncrementUnit"), F.col("framerate_hz").alias("FramerateHz"),
    )
    return rows.select("stack", F.to_json(meta).alias("meta"))


def overlaps(acquisitions: DataFrame) -> DataFrame:
    """(timeline_index, overlap): overlapping pixels of the first acquisition that has tiles on that timeline, 0 if none has."""
    lines = acquisitions.select("acquisition_index", F.posexplode("setting.timelapse.timeline").alias("i", "line"))
    specs = lines.select("acquisition_index", (F.col("i") + 1).alias("timeline_index"), F.col("line.point_sequence.partial_tiled_position.overlapping_pixels").alias("overlap"))
    return records.overlap_pixels(specs, ["timeline_index"], "acquisition_index")


def plan(m: Measurements, listing: DataFrame, *, title: str | None = None, z_mode: str = "maxz", z_mode_bf: str = "keep", correct: bool = True, tile_mode: str = "per-field", no_merge: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(planes to assemble, metadata of their stacks, rejected stacks with reasons), without reading a pixel."""
    for mode in (z_mode, z_mode_bf):
        if mode not in ops.MODES:
            raise ValueError(f"z mode must be one of {', '.join(ops.MODES)}, not {mode!r}")
    rec = m.records.withColumnRenamed("acquisition_index", "acquisition")
    keyed = records.stack_keys(rec, no_merge, tile_mode)
    channels = channels_of(m.acquisitions)
    names = stack_names(keyed, channel_settings(m.acquisitions), title)
    used = keyed.select(*records.STACK, "acquisition", "ch").distinct().join(channels, ["acquisition", "ch"])
    uneven = records.pixel_sizes(used).where("NOT consistent").select(*records.STACK, F.lit("pixel sizes differ between channels").alias("reason"))
    bad = records.stack_problems(keyed).unionByName(uneven).groupBy(*records.STACK).agg(F.min("reason").alias("reason"))
    rejected = records.same_stack(names, bad).select("stack", "reason")
    named = records.same_stack(keyed, names)
    placed = records.tile_positions(records.plane_positions(named.join(rejected.select("stack"), "stack", "left_anti")))
    grid = placed.groupBy("stack").agg((F.max("gy") + 1).alias("rows"), (F.max("gx") + 1).alias("cols"))
    placed = placed.join(grid, "stack").join(overlaps(m.acquisitions), "timeline_index", "left").withColumn("overlap", F.coalesce("overlap", F.lit(0)))
    if correct:
        refs = correction_paths(rec, channels, listing)
        refs = refs.withColumnsRenamed({"acquisition": "_acq", "ch": "_ch"})
        on = (F.col("acquisition") == F.col("_acq")) & (F.col("ch") == F.col("_ch")) & records.corrected(F.col("action"))
        placed = placed.join(refs, on, "left")
    else:
        placed = placed.withColumns({"dark_path": F.lit(None).cast("string"), "flat_path": F.lit(None).cast("string")})
    placed = placed.withColumn("mode", records.z_mode_of(F.col("action"), z_mode, z_mode_bf))
    mode = records.z_mode_of(F.col("action"), z_mode, z_mode_bf)
    meta = stack_metadata(placed, names, m.acquisitions, mode)
    return placed.select("stack", "t", "c", "z", "kind", "gy", "gx", "rows", "cols", "overlap", "tif_path", "dark_path", "flat_path", "mode"), meta, rejected


def compile_measurements(spark: SparkSession, root: str, out_dir: str, *, format: str = "tiff", overwrite: bool = False, exclude: Sequence[str] = (), include: Sequence[str] = (), compression: str = "lzw", dry_run: bool = False, keep: Callable = materialize, **how) -> DataFrame:
    """Write every stack below ``root`` to ``out_dir`` and return (stack, path, success, size, error).

    ``how``: title, z_mode, z_mode_bf, correct, tile_mode, no_merge of ``plan``.  A stack that can't be assembled or
    written is a row with its error; others go on.  Outputs that exist are left out unless ``overwrite``, before
    anything is read.  A dry run plans all and writes nothing: its rows have no path.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}, not {format!r}")
    m = read_measurements(spark, root, exclude, include)
    planes, meta, rejected = plan(m, files.list_files(spark, root, "*.tif").select("path"), **how)
    out = rejected.select("stack", F.lit(None).cast("string").alias("path"), F.lit(False).alias("success"), F.lit(0).cast("long").alias("size"), F.col("reason").alias("error"))
    meta = keep(meta, "stack-metadata")
    if dry_run:
        return out.unionByName(meta.select("stack", F.lit(None).cast("string").alias("path"), F.lit(True).alias("success"), F.lit(0).cast("long").alias("size"), F.lit(None).cast("string").alias("error")))
    kinds = [k for k in ("zarr", "tiff") if format in (k, "both")]
    there = files.list_files(spark, out_dir)
    done = {
        "tiff": there.where(F.col("name").endswith(".ome.tif")).select(F.regexp_replace("name", r"\.ome\.tif$", "").alias("stack")),
        "zarr": there.where("name = '.zattrs'").select(F.regexp_extract("parent", r"([^/]+)\.ome\.zarr$", 1).alias("stack")),
    }
    wanted = {k: keep(records.missing_outputs(meta, done[k], "stack", overwrite), f"wanted-{k}") for k in kinds}
    if overwrite and "zarr" in kinds:
        for row in wanted["zarr"].select("stack").toLocalIterator():
            files.remove(f"{out_dir.rstrip('/')}/{row['stack']}.ome.zarr")
    any_ = wanted[kinds[0]].select("stack") if len(kinds) == 1 else wanted["zarr"].select("stack").union(wanted["tiff"].select("stack")).distinct()
    made = assembled(planes.join(any_, "stack", "left_semi"))
    if len(kinds) > 1:
        made = made.persist(StorageLevel.MEMORY_AND_DISK)  # pixels are made once and written twice
    for kind in kinds:
        own = made.join(wanted[kind].select("stack"), "stack", "left_semi") if len(kinds) > 1 else made
        wrote = write_ome_tiffs(own, wanted[kind], out_dir, compression) if kind == "tiff" else write_ome_zarrs(own, wanted[kind], out_dir, keep)
        out = out.unionByName(keep(wrote, f"results-{kind}"))
    made.unpersist()
    return out
