"""Relational operators over measurement records: order, grouping, validation, lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import well_column, well_row
from ..functions.times import has_offset, instant, seconds

#: What names a field stack; split_acq is null unless its action is kept apart by acquisition.
STACK = ("row", "column", "kind", "position", "timeline_index", "action_index", "action", "split_acq")


# Order


def chronological(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``rank`` from 0 by time; by string if any value can't be read as a time or some but not all name an offset.

    One row per measurement is ranked, not one per record.  A null can't be read.
    """
    stamp, rest = instant(F.col(column))
    df = df.withColumn("_stamp", stamp).withColumn("_rest", rest).withColumn("_aware", has_offset(F.col(column)))
    every = Window.partitionBy()
    readable = F.min(F.col("_stamp").isNotNull()).over(every) & (F.min("_aware").over(every) == F.max("_aware").over(every))
    df = df.withColumn("_ok", readable)
    order = Window.orderBy(F.when(F.col("_ok"), F.col("_stamp")), F.when(F.col("_ok"), F.col("_rest")), column)
    return df.withColumn("rank", F.row_number().over(order) - 1).drop("_stamp", "_rest", "_aware", "_ok")


def duplicate_instants(df: DataFrame, column: str) -> DataFrame:
    """(n) of each instant that more than one row has, whatever offset it is written with."""
    stamp, rest = instant(F.col(column))
    return df.select(stamp.alias("s"), rest.alias("r")).where("s IS NOT NULL").groupBy("s", "r").agg(F.count("*").alias("n")).where("n > 1").select("n")


def numbered(df: DataFrame, order: Sequence[str], name: str = "pos") -> DataFrame:
    """``df`` with the position from 1 in the order of the columns ``order``, nulls first, without a task that sees all rows.

    Rows are dealt by ranges; each range is numbered by itself from the count of the ranges before it.  A range
    partitioning is by samples, so it is fixed by a checkpoint before it is counted and numbered.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id())
    placed = _checkpointed(placed)
    counts = placed.groupBy("_part").count()
    before = counts.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))  # one row a range
    here = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + here).drop("_part", "_before")


def _checkpointed(df: DataFrame) -> DataFrame:
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        from ..scratch import scratch_dir

        sc.setCheckpointDir(scratch_dir(df.sparkSession))
    return df.checkpoint()


def catalog_sorted(entries: DataFrame, name: str = "pos") -> DataFrame:
    """Catalogue entries with their position: well, action, its index, field or tile, acquisition, stem; nulls as 0 or empty."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    number = lambda *c: F.coalesce(*[F.nullif(F.col(x), F.lit(0)) for x in c], F.lit(0))
    keys = {"_k1": text("well"), "_k2": text("action"), "_k3": number("action_index"), "_k4": number("field_index", "partial_tile_index"), "_k5": number("acquisition_index"), "_k6": text("stem")}
    return numbered(entries.select("*", *[c.alias(k) for k, c in keys.items()]), list(keys), name).drop(*keys)


# Filters


def without_keywords(df: DataFrame, column: str, keywords: Sequence[str], keep: bool = False) -> DataFrame:
    """Rows whose text holds none (or, with ``keep``, one) of the keywords, in any case."""
    if not keywords:
        return df
    found = None
    for word in keywords:
        hit = F.contains(F.lower(column), F.lit(word.lower()))
        found = hit if found is None else found | hit
    return df.where(found if keep else ~found)


def images_only(rec: DataFrame, column: str = "type", image: Sequence[str] = ("IMG",)) -> DataFrame:
    """Records that are images; soft focus and error records drop out."""
    return rec.where(F.col(column).isin(*image))


def tiled_acquisitions(rec: DataFrame) -> DataFrame:
    """(acquisition, is_tiled): whether any of its images has a tile index."""
    return rec.groupBy("acquisition").agg(F.bool_or(F.col("tile_x_index").isNotNull()).alias("is_tiled"))


def tiled_part(rec: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with a tile index, the others)."""
    tiled = F.col("tile_x_index").isNotNull()
    return rec.where(tiled), rec.where(~tiled)


def z_mode_of(action: Column, z_mode: str | Column, z_mode_bf: str | Column) -> Column:
    """The projection of an action: ``BF3D`` has its own."""
    value = lambda m: F.lit(m) if isinstance(m, str) else m
    return F.when(action == "BF3D", value(z_mode_bf)).otherwise(value(z_mode))


def corrected(action: Column) -> Column:
    """Whether an action's images are corrected: not if its name holds ``BF``."""
    return ~F.contains(action, F.lit("BF"))


def missing_outputs(wanted: DataFrame, existing: DataFrame, column: str, overwrite: bool = False) -> DataFrame:
    """Rows of ``wanted`` whose output isn't there yet; all of them with ``overwrite``."""
    return wanted if overwrite else wanted.join(existing.select(column).distinct(), column, "left_anti")


def existing(wanted: DataFrame, listing: DataFrame, column: str = "path") -> DataFrame:
    """``wanted`` with ``exists``: whether its path is in the listing."""
    there = listing.select(column).distinct().withColumn("exists", F.lit(True))
    return wanted.join(there, column, "left").withColumn("exists", F.coalesce("exists", F.lit(False)))


# Stacks


def stack_keys(rec: DataFrame, no_merge: Sequence[str] = (), tile_mode: str = "stitch") -> DataFrame:
    """``rec`` with the stack's keys kind, position and split_acq; records without a position drop out.

    With tile_mode ``stitch`` tiled records group by mosaic (partial_tile_index), others by field; with ``per-field`` all by
    field.  Actions in ``no_merge`` stay apart by acquisition, others merge over all.
    """
    if tile_mode not in ("stitch", "per-field"):
        raise ValueError(f"tile_mode must be 'stitch' or 'per-field', not {tile_mode!r}")
    tiled = F.col("tile_x_index").isNotNull() if tile_mode == "stitch" else F.lit(False)
    position = F.when(tiled, F.col("partial_tile_index")).otherwise(F.col("field_index"))
    names = [a.strip().lower() for a in no_merge if a.strip()]
    alone = F.lower(F.trim("action")).isin(names) if names else F.lit(False)
    keyed = rec.withColumns({"kind": F.when(tiled, "tile").otherwise("field"), "position": position, "split_acq": F.when(alone, F.col("acquisition"))})
    present = [c for c in STACK if c != "split_acq"]
    return keyed.where(F.forall(F.array(*[F.col(c).isNotNull() for c in present]), lambda x: x))


def fieldstacks(rec: DataFrame, no_merge: Sequence[str] = (), tile_mode: str = "stitch") -> DataFrame:
    """One row per field stack: its keys and n, the number of planes."""
    return stack_keys(rec, no_merge, tile_mode).groupBy(*STACK).agg(F.count("*").alias("n"))


def completeness(keyed: DataFrame) -> DataFrame:
    """Planes found of each stack against T * C * Z * tiles; T counts each acquisition's time points, tiles those of a mosaic."""
    tile = F.when((F.col("kind") == "tile") & F.col("tile_x_index").isNotNull() & F.col("tile_y_index").isNotNull(), F.struct("tile_x_index", "tile_y_index"))
    counts = keyed.groupBy(*STACK).agg(
        F.count("*").alias("n"), F.countDistinct("acquisition", "time_point").alias("t"), F.countDistinct("ch").alias("c"),
        F.countDistinct("z_index").alias("z"), F.countDistinct(tile).alias("tiles"),
    )
    # Z is the number per acquisition, which other checks find equal.
    depth = keyed.groupBy(*STACK, "acquisition").agg(F.countDistinct("z_index").alias("z")).groupBy(*STACK).agg(F.max("z").alias("z"))
    counts = same_stack(counts.drop("z"), depth).withColumn("tiles", F.when(F.col("kind") == "tile", F.col("tiles")).otherwise(F.lit(1).cast("long")))
    return counts.withColumn("expected", F.col("t") * F.col("c") * F.col("z") * F.col("tiles")).withColumn("complete", F.col("n") == F.col("expected"))


def same_stack(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the stack's keys, where a null split_acq equals a null."""
    right = right.select(*[F.col(c).alias(f"_{c}") if c in STACK else F.col(c) for c in right.columns])
    on = F.col("row") == F.col("_row")
    for c in STACK[1:]:
        on &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(right, on, how).drop(*[f"_{c}" for c in STACK])


def equal_channels(keyed: DataFrame, keys: Sequence[str] = STACK) -> DataFrame:
    """Whether all acquisitions of a stack have the same channels, in any order."""
    sets = keyed.groupBy(*keys, "acquisition").agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_set("ch")), lambda x: x.cast("string"))).alias("s"))
    return sets.groupBy(*keys).agg((F.countDistinct("s") == 1).alias("same"))


def equal_depths(keyed: DataFrame, keys: Sequence[str] = STACK) -> DataFrame:
    """Whether all acquisitions of a stack have the same number of Z slices."""
    counts = keyed.groupBy(*keys, "acquisition").agg(F.countDistinct("z_index").alias("n"))
    return counts.groupBy(*keys).agg((F.min("n") == F.max("n")).alias("same"))


def stack_problems(keyed: DataFrame) -> DataFrame:
    """(stack keys, reason) of stacks that can't be assembled: other channels, other depths, or planes missing or too many."""
    reasons = [
        (equal_channels(keyed).where("NOT same"), "acquisitions have different channels", 1),
        (equal_depths(keyed).where("NOT same"), "acquisitions have an unequal number of Z slices", 2),
        (completeness(keyed).where("NOT complete"), None, 3),
    ]
    out = None
    for df, text, order in reasons:
        said = F.lit(text) if text else F.format_string("%d planes found, %d expected", "n", "expected")
        part = df.select(*STACK, F.struct(F.lit(order).alias("order"), said.alias("reason")).alias("why"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy(*STACK).agg(F.min("why").alias("why")).select(*STACK, "why.reason")


def plane_positions(keyed: DataFrame) -> DataFrame:
    """``keyed`` with the positions t, c, z from 0 of each plane in its stack.

    t runs over (acquisition, time point), c over channels, z over each acquisition's own slices.
    """
    rank = lambda w: (F.dense_rank().over(w) - 1).cast("int")
    by = Window.partitionBy(*STACK)
    return keyed.withColumns({
        "t": rank(by.orderBy("acquisition", "time_point")), "c": rank(by.orderBy("ch")), "z": rank(Window.partitionBy(*STACK, "acquisition").orderBy("z_index")),
    })


def tile_positions(placed: DataFrame) -> DataFrame:
    """``placed`` with the grid positions gy, gx from 0 of each tile in its mosaic: ranks of the indices, so gaps close."""
    rank = lambda c: (F.dense_rank().over(Window.partitionBy(*STACK).orderBy(c)) - 1).cast("int")
    return placed.withColumns({"gy": rank("tile_y_index"), "gx": rank("tile_x_index")})


def tile_grid(keyed: DataFrame) -> DataFrame:
    """(stack keys, grid_x, grid_y, tiles) of mosaics."""
    return keyed.where("kind = 'tile'").groupBy(*STACK).agg(F.countDistinct("tile_x_index").alias("grid_x"), F.countDistinct("tile_y_index").alias("grid_y"), F.countDistinct("tile_x_index", "tile_y_index").alias("tiles"))


def earliest_times(placed: DataFrame, time: str = "time") -> DataFrame:
    """(stack keys, t, time): the earliest time of each frame's planes."""
    return placed.groupBy(*STACK, "t").agg(F.min(time).alias("time"))


def begin_times(rec: DataFrame) -> DataFrame:
    """(acquisition, begin_time), each once."""
    return rec.select("acquisition", "begin_time").distinct()


# Times of frames


def frame_times(frames: DataFrame, keys: Sequence[str], order: Sequence[str], at: str = "s") -> DataFrame:
    """``frames`` with the seconds since the key's first known time, and since the frame before where both are known."""
    by = Window.partitionBy(*keys).orderBy(*order)
    first = F.first(at, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return frames.withColumns({"relative": F.col(at) - first, "interval": F.col(at) - F.lag(at).over(by)})


def with_seconds(frames: DataFrame, time: str, name: str = "s") -> DataFrame:
    return frames.withColumn(name, seconds(F.col(time)))


def time_metadata(timed: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key with at least two known times: relative_times, frame_intervals, time_increment (median), framerate_hz.

    ``timed`` is what ``frame_times`` gives.  A frame without a time keeps its place in relative_times as null; the rate
    is null where the median interval is not positive or there is no interval.
    """
    rows = timed.groupBy(*keys).agg(
        F.count("relative").alias("known"), F.median("interval").alias("time_increment"),
        F.array_sort(F.collect_list(F.struct(*order, "relative"))).alias("all"),
        F.array_sort(F.collect_list(F.when(F.col("interval").isNotNull(), F.struct(*order, "interval")))).alias("gaps"),
    )
    rate = F.when(F.col("time_increment") > 0, 1 / F.col("time_increment"))
    return rows.where("known >= 2").select(*keys, F.col("all.relative").alias("relative_times"), F.col("gaps.interval").alias("frame_intervals"), "time_increment", rate.alias("framerate_hz"))


def plane_metadata(stacks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A row (t, c, z, delta_t) for each plane of stacks (keys, size_t, size_c, size_z, relative_times); none without any time."""
    axis = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    known = stacks.where(F.exists("relative_times", lambda x: x.isNotNull()))
    out = known.select("*", axis("size_t").alias("t")).select("*", axis("size_c").alias("c")).select("*", axis("size_z").alias("z"))
    return out.select(*keys, "t", "c", "z", F.get("relative_times", F.col("t")).alias("delta_t"))


# Lookups


def with_acquisition(rec: DataFrame, acquisitions: DataFrame) -> DataFrame:
    """Records with their acquisition's columns."""
    return rec.join(acquisitions, "acquisition")


def with_channel(rec: DataFrame, channels: DataFrame, keys: Sequence[str] = ("acquisition", "ch")) -> DataFrame:
    """Records with their channel's columns by channel number; without a listed channel those are null."""
    return rec.join(channels, list(keys), "left")


def pixel_sizes(used: DataFrame, keys: Sequence[str] = STACK) -> DataFrame:
    """(keys, size_y, size_x, consistent) over the used channels' pixel sizes; 1.0 where none is listed.

    consistent is false where a stack's channels have different sizes: such a stack can't be calibrated.
    """
    one = used.groupBy(*keys).agg(F.min("pixel_y").alias("y"), F.max("pixel_y").alias("y2"), F.min("pixel_x").alias("x"), F.max("pixel_x").alias("x2"))
    same = F.col("y").eqNullSafe(F.col("y2")) & F.col("x").eqNullSafe(F.col("x2"))
    return one.select(*keys, F.coalesce("y", F.lit(1.0)).alias("size_y"), F.coalesce("x", F.lit(1.0)).alias("size_x"), same.alias("consistent"))


def timeline_at(timelines: Column, index: Column) -> Column:
    """The timeline of a 1-based position, null outside the list."""
    return F.when((index >= 1) & (index <= F.size(timelines)), F.get(timelines, index - 1))


def overlap_pixels(specs: DataFrame, keys: Sequence[str], order: str, column: str = "overlap") -> DataFrame:
    """(keys, overlap): that of the first acquisition with a tile specification, 0 if none has."""
    return specs.groupBy(*keys).agg(F.coalesce(F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order))), F.lit(0)).alias("overlap"))


def first_record(rec: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, columns) of each key's first record in the order of ``order``, which must be total."""
    first = rec.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_first"))
    return first.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in columns])


def plate(wells: DataFrame, column: str = "well") -> DataFrame:
    """One row (n_rows, n_cols, label): the smallest standard plate that holds all readable wells."""
    found = wells.agg(F.max(well_row(F.col(column))).alias("r"), F.max(well_column(F.col(column))).alias("c"))
    size = lambda a, b, c: F.when((F.col("r") <= 8) & (F.col("c") <= 12), a).when((F.col("r") <= 16) & (F.col("c") <= 24), b).when((F.col("r") <= 32) & (F.col("c") <= 48), c)
    own = F.format_string("%d×%d (custom)", "r", "c")
    return found.select(
        F.coalesce(size(8, 16, 32).otherwise(F.col("r")), F.lit(0)).alias("n_rows"), F.coalesce(size(12, 24, 48).otherwise(F.col("c")), F.lit(0)).alias("n_cols"),
        F.when(F.col("r").isNull(), "no plate").otherwise(size("96-well", "384-well", "1536-well").otherwise(own)).alias("label"),
    )


def plate_grid(size: DataFrame, counts: DataFrame) -> DataFrame:
    """A row (r, c, n) for each well of a plate (n_rows, n_cols); n is 0 where ``counts`` (r, c, n) has no row."""
    axis = lambda n: F.explode(F.sequence(F.lit(1), F.col(n)))
    grid = size.where("n_rows > 0").select(axis("n_rows").alias("r"), "n_cols").select("r", axis("n_cols").alias("c"))
    return grid.join(counts, ["r", "c"], "left").select("r", "c", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def catalog_counts(entries: DataFrame) -> DataFrame:
    """(datasets, wells, actions): entries, distinct wells but ``unknown``, distinct actions that aren't empty."""
    known = F.when(F.col("well") != "unknown", F.col("well"))
    return entries.agg(F.count("*").alias("datasets"), F.countDistinct(known).alias("wells"), F.countDistinct(F.nullif("action", F.lit(""))).alias("actions"))


def group_counts(entries: DataFrame, by_well: bool = True) -> DataFrame:
    """Entries of each (well, action), or with ``by_well`` false of each action."""
    return entries.groupBy(*(["well"] if by_well else []), F.coalesce(F.nullif("action", F.lit("")), F.lit("—")).alias("action")).agg(F.count("*").alias("n"))


def visible(entries: DataFrame, well: str | None = None, actions: Sequence[str] = (), query: str = "") -> DataFrame:
    """Entries of a well, of some actions, and with the query in stem, action or well; what isn't given doesn't filter."""
    text = query.strip().lower()
    out = entries if well is None else entries.where(F.col("well") == well)
    out = out.where(F.col("action").isin(*actions)) if actions else out
    hit = lambda c: F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(text))
    return out.where(hit("stem") | hit("action") | hit("well")) if text else out


# Summaries


def reduction(size_in: Column, size_out: Column) -> Column:
    """Per cent saved."""
    return (1 - size_out / F.greatest(size_in, F.lit(1))) * 100


def job_summary(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, processed, succeeded, failed, size_in, size_out, reduction, ok) of jobs (success, input_size, output_size); ok if all succeeded."""
    return results.groupBy(*keys).agg(
        F.count("*").alias("processed"), F.count_if("success").alias("succeeded"), F.count_if(~F.coalesce(F.col("success"), F.lit(False))).alias("failed"),
        F.sum("input_size").cast("long").alias("size_in"), F.sum("output_size").cast("long").alias("size_out"),
        reduction(F.sum("input_size"), F.sum("output_size")).alias("reduction"), F.bool_and(F.coalesce(F.col("success"), F.lit(False))).alias("ok"),
    )


def preview_totals(results: DataFrame) -> DataFrame:
    """(converted, errors, size_in, size_out, ratio) of previews; sizes are those of files that were converted."""
    good = lambda c: F.coalesce(F.sum(F.when(F.col("error").isNull(), F.col(c))), F.lit(0)).cast("long")
    out = results.agg(F.count_if(F.col("error").isNull()).alias("converted"), F.count_if(F.col("error").isNotNull()).alias("errors"), good("input_size").alias("size_in"), good("output_size").alias("size_out"))
    return out.withColumn("ratio", F.col("size_in") / F.greatest("size_out", F.lit(1)))


def evenly(n: int, most: int = 24) -> list[int]:
    """Positions of at most ``most`` evenly spaced frames of n."""
    k = min(most, n)
    return sorted({int(i * (n - 1) / (k - 1)) if k > 1 else 0 for i in range(k)}) if n else []


def subsample(frames: DataFrame, keys: Sequence[str], order: Sequence[str], most: int = 24) -> DataFrame:
    """At most ``most`` evenly spaced frames of each key, the first and the last among them."""
    rows = frames.withColumns({"_i": F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1, "_n": F.count("*").over(Window.partitionBy(*keys))})
    k = F.least(F.lit(most), F.col("_n"))
    # Frame i is wanted if some j in 0..k-1 has floor(j (n - 1) / (k - 1)) = i; the least such j is ceil(i (k - 1) / (n - 1)).
    j = F.ceil(F.col("_i") * (k - 1) / (F.col("_n") - 1))
    wanted = F.when(F.col("_n") <= most, F.lit(True)).otherwise((j <= k - 1) & (F.floor(j * (F.col("_n") - 1) / (k - 1)) == F.col("_i")))
    return rows.where(wanted if most > 1 else F.col("_i") == 0).drop("_i", "_n")
