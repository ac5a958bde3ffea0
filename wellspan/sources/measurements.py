"""Measurement directories: four XML files and single-plane TIFFs each, as DataFrames."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.records import chronological, duplicate_instants, without_keywords

#: Fixed names: elements and attributes of the vendor's files.
RECORD = """_Type string, _Time string, _Column int, _Row int, _TimePoint int, _TimelineIndex int, _X double, _Y double, _VALUE string, _FieldIndex int,
    _PartialTileIndex int, _TileXIndex int, _TileYIndex int, _ZIndex int, _ActionIndex int, _Action string, _Ch int, _Z double,
    _ZImageProcessing string, _ZTop double, _ZBottom double"""
CHANNEL = """_Ch int, _HorizontalPixelDimension double, _VerticalPixelDimension double, _CameraNumber int, _InputBitDepth int, _InputLevel int,
    _HorizontalPixels int, _VerticalPixels int, _FilterWheelPosition int, _FilterPosition int, _ShadingCorrectionSource string, _ObjectiveMagnificationRatio double"""
DETAIL = f"""_BeginTime string, _EndTime string, _Title string, _OperatorName string, _MeasurementSettingFileName string, _ColumnCount int, _RowCount int,
    _TimePointCount int, _FieldCount int, _ZCount int, MeasurementChannel array<struct<{CHANNEL.replace(' string', ': string').replace(' int', ': int').replace(' double', ': double')}>>"""
SETTING = """_Columns int, _Rows int,
    Timelapse struct<Timeline: array<struct<_Name: string, _InitialTime: int, _Period: int, _Interval: int, _ExpectedTime: int,
        PointSequence: struct<_Method: string, PartialTiledPosition: struct<_OverlappingPixels: int, _ScanMethod: string>>>>>,
    ChannelList struct<Channel: array<struct<_Ch: int, _Magnification: int, _Objective: string, _ExposureTime: int, _Acquisition: string, _Method: string, _Fluorophore: string>>>"""
PLATE = "_Name string, _Columns int, _Rows int"
#: Columns that each record needs, and those that an image needs besides.
ALWAYS = ("type", "time", "column", "row", "time_point", "timeline_index", "x", "y")
IMAGE = ("z_index", "action_index", "action", "z", "ch")


class Measurements(NamedTuple):
    """``records``: an image plane each; ``acquisitions``: a measurement each; ``rejected``: (base_path, reason)."""

    records: DataFrame
    acquisitions: DataFrame
    rejected: DataFrame


def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name.lstrip("_")).lower()


def _renamed(t: T.DataType) -> T.DataType:
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(snake(f.name), _renamed(f.dataType)) for f in t.fields])
    return T.ArrayType(_renamed(t.elementType)) if isinstance(t, T.ArrayType) else t


def plain_path(path: Column) -> Column:
    """A path as Hadoop writes it: no percent escapes, one slash after ``file:``."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def parent(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]+$", "")


def find_measurements(spark: SparkSession, root: str) -> DataFrame:
    """(path, base_path) of each ``*.wpi`` file at any depth."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wpi").load(root)
    path = F.regexp_replace("path", "^file:/+", "file:/")
    return files.select(path.alias("path"), parent(path).alias("base_path"))


def read_xml(spark: SparkSession, root: str, files: str, tag: str, schema: str) -> DataFrame:
    """Rows of the elements ``tag`` in files that match the glob, with snake-case names, their ``path`` and ``base_path``."""
    raw = (
        spark.read.format("xml").schema(schema).option("rowTag", tag).option("ignoreNamespace", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", files).load(root)
    )
    columns = [F.col(f.name).cast(_renamed(f.dataType)).alias(snake(f.name)) for f in raw.schema.fields]
    path = plain_path(F.col("_metadata.file_path"))
    return raw.select(*columns, path.alias("path")).withColumn("base_path", parent(F.col("path")))


def read_measurements(spark: SparkSession, root: str, exclude: Sequence[str] = (), include: Sequence[str] = ()) -> Measurements:
    """All measurements below ``root``; one that lacks a file or a required value is rejected as a whole.

    Images only become records.  ``acquisition_index`` counts from 0 by begin time.  Raises ValueError when two
    begin times are one instant, or when no measurement is left.
    """
    wanted = find_measurements(spark, root)
    if wanted.isEmpty():
        raise ValueError(f"no measurement below {root}")
    for words, keep, said in ((exclude, False, "is left by the excluded"), (include, True, "has one of the included")):
        wanted = without_keywords(wanted, "path", words, keep)
        if words and wanted.isEmpty():
            raise ValueError(f"no measurement {said} keywords: {', '.join(words)}")
    raw = read_xml(spark, root, "MeasurementData.mlf", "MeasurementRecord", RECORD)
    missing = F.exists(F.array(*[F.col(c).isNull() for c in ALWAYS]), lambda x: x)
    no_image = (F.col("type") == "IMG") & F.exists(F.array(*[F.col(c).isNull() for c in IMAGE]), lambda x: x)
    bad = missing | no_image | ~F.col("type").isin("IMG", "SF", "ERR")
    state = raw.groupBy("base_path").agg(F.max(F.coalesce(bad, F.lit(True))).alias("bad_record"), F.count_if(F.col("type") == "IMG").alias("images"))
    detail = read_xml(spark, root, "MeasurementDetail.mrf", "MeasurementDetail", DETAIL).drop("path")
    setting = read_xml(spark, root, "*.mes", "MeasurementSetting", SETTING)
    setting = setting.select("base_path", F.regexp_extract("path", "[^/]+$", 0).alias("measurement_setting_file_name"), F.struct("columns", "rows", "timelapse", "channel_list").alias("setting"))
    plate = read_xml(spark, root, "*.wpi", "WellPlate", PLATE).select("path", F.struct("name", "columns", "rows").alias("well_plate"))
    joined = wanted.join(plate, "path", "left").join(state, "base_path", "left").join(detail.withColumn("has_detail", F.lit(True)), "base_path", "left")
    joined = joined.join(setting, ["base_path", "measurement_setting_file_name"], "left")
    reason = (
        F.when(F.col("bad_record").isNull(), "no MeasurementData.mlf").when(F.col("has_detail").isNull(), "no MeasurementDetail.mrf")
        .when(F.col("measurement_setting_file_name").isNull(), "no setting file named").when(F.col("setting").isNull(), "setting file missing")
        .when(F.col("begin_time").isNull(), "no begin time").when(F.col("bad_record"), "record without a required value").when(F.col("images") == 0, "no image")
    )
    joined = joined.withColumn("reason", reason)
    good = joined.where("reason IS NULL").drop("reason", "bad_record", "has_detail", "images")
    if good.isEmpty():
        raise ValueError(f"no measurement can be read below {root}")
    if not duplicate_instants(good, "begin_time").isEmpty():
        raise ValueError("Duplicate begin times")
    acquisitions = chronological(good, "begin_time").withColumnRenamed("rank", "acquisition_index")
    of = acquisitions.select("base_path", "acquisition_index", "begin_time", "title")
    records = raw.where("type = 'IMG'").drop("path").join(of, "base_path")
    records = records.withColumn("tif_path", F.concat_ws("/", "base_path", F.trim(F.replace("value", F.lit("\\"), F.lit("/")))))
    return Measurements(records, acquisitions, joined.where("reason IS NOT NULL").select("base_path", "reason"))
