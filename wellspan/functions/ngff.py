"""Metadata of multiscale arrays: axes, scales, chunks, display windows, as Columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the format: type and unit of each axis.
AXES = {"t": ("time", "second"), "c": ("channel", None), "z": ("space", "micrometer"), "y": ("space", "micrometer"), "x": ("space", "micrometer")}
#: Metadata keys that have a place of their own in image files; others are extras.
STANDARD = (
    "axes", "PhysicalSizeX", "PhysicalSizeY", "PhysicalSizeZ", "PhysicalSizeXUnit", "PhysicalSizeYUnit", "PhysicalSizeZUnit",
    "TimeIncrement", "TimeIncrementUnit", "Channels", "Plane", "Description", "Creator", "Name",
)


def letters(axes: Column) -> Column:
    return F.filter(F.split(F.lower(axes), ""), lambda x: x != "")


def axes_list(axes: Column) -> Column:
    """Array of (name, type, unit) of an axes string such as ``TCYX``."""
    kind = F.create_map(*[x for k, (v, _) in AXES.items() for x in (F.lit(k), F.lit(v))])
    unit = F.create_map(*[x for k, (_, u) in AXES.items() if u for x in (F.lit(k), F.lit(u))])
    return F.transform(letters(axes), lambda a: F.struct(a.alias("name"), F.get(F.map_values(F.map_filter(kind, lambda k, _: k == a)), F.lit(0)).alias("type"), F.get(F.map_values(F.map_filter(unit, lambda k, _: k == a)), F.lit(0)).alias("unit")))


def scales(axes: Column, level: Column, size_y: Column, size_x: Column, size_z: Column, increment: Column) -> Column:
    """Scale of each axis at a pyramid level; sizes that are null or zero count as 1, Y and X double with each level."""
    known = lambda c: F.coalesce(F.nullif(c.cast("double"), F.lit(0.0)), F.lit(1.0))
    stride = F.pow(F.lit(2.0), level)
    t, z, y, x = known(increment), known(size_z), known(size_y) * stride, known(size_x) * stride
    return F.transform(letters(axes), lambda a: F.when(a == "t", t).when(a == "z", z).when(a == "y", y).when(a == "x", x).otherwise(1.0))


def chunk_shape(axes: Column, shape: Column, side: int = 512) -> Column:
    """Chunks: 1 along T, C and Z, at most ``side`` along Y and X."""
    return F.zip_with(letters(axes), shape, lambda a, n: F.when(a.isin("y", "x"), F.least(F.lit(side), n.cast("int"))).otherwise(1))


def level_shape(axes: Column, shape: Column, level: Column) -> Column:
    """Shape after taking every 2**level-th pixel along Y and X."""
    stride = F.pow(F.lit(2), level)
    return F.zip_with(letters(axes), shape, lambda a, n: F.when(a.isin("y", "x"), F.ceil(n / stride)).otherwise(n).cast("int"))


def level_count(height: Column, width: Column, most: int = 4, least: int = 16) -> Column:
    """Levels until an axis would fall under ``least`` pixels, at least one."""
    fits = F.filter(F.sequence(F.lit(1), F.lit(most - 1)), lambda k: (height >= least * F.pow(F.lit(2), k)) & (width >= least * F.pow(F.lit(2), k)))
    return (F.size(fits) + 1).cast("int")


def display_channel(label: Column, start: Column, end: Column, low: float = 0.0, high: float = 65535.0) -> Column:
    """A channel's display settings: white, the type's whole range, from ``start`` to ``end`` (the range where null)."""
    window = F.struct(F.lit(low).alias("min"), F.lit(high).alias("max"), F.coalesce(start, F.lit(low)).alias("start"), F.coalesce(end, F.lit(high)).alias("end"))
    return F.struct(F.coalesce(label, F.lit("Channel")).alias("label"), F.lit("FFFFFF").alias("color"), window.alias("window"), F.lit(True).alias("active"))


def standard_part(metadata: Column, keys: Sequence[str] = STANDARD) -> Column:
    """The entries of a map that image files have a place for."""
    return F.map_filter(metadata, lambda k, _: k.isin(*keys))


def extra_part(metadata: Column, keys: Sequence[str] = STANDARD) -> Column:
    return F.map_filter(metadata, lambda k, _: ~k.isin(*keys))


def squeezed_axes(t: Column, c: Column, z: Column, y: Column, x: Column) -> Column:
    """Axes of more than one element of a stack of these sizes, in the order TCZYX."""
    return F.concat(*[F.when(n > 1, F.lit(a)).otherwise("") for a, n in zip("TCZYX", (t, c, z, y, x), strict=True)])
