"""The image planes and measurement records that queries work on, derived from the driver's tables.

``planes`` reads each embedding as an 8 x 8 plane of 16-bit pixels; ``rec`` reads events as plane records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Frames, channels and slices of a stack as planned; the last stack of a table may lack planes.
FRAMES, CHANNELS, SLICES = 25, 2, 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pixels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            flat = part.column(1).flatten()
            values = np.floor((flat.to_numpy(zero_copy_only=False).astype(float) + 1) * 32767).astype("<u2").reshape(part.num_rows, -1)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([v.tobytes() for v in values], pa.binary())], ["vec_id", "px"])


def planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, stack, acquisition, t, c, z, h, w, px): stacks of 25 frames, 2 channels and 5 slices, the last of which may lack planes."""
    px = table(spark, sf_dir, "embeddings").select("vec_id", "embedding").mapInArrow(_pixels, "vec_id long, px binary")
    return px.selectExpr(
        "vec_id", "CAST(vec_id div 250 AS INT) AS stack", "CAST(vec_id % 250 div 125 AS INT) AS acquisition", "CAST(vec_id % 250 div 10 AS INT) AS t",
        "CAST(vec_id div 5 % 2 AS INT) AS c", "CAST(vec_id % 5 AS INT) AS z", "8 AS h", "8 AS w", "px",
    )


PX = """px AS (SELECT vec_id, CAST(vec_id // 250 AS INT) AS stack, CAST(vec_id % 250 // 125 AS INT) AS acquisition, CAST(vec_id % 250 // 10 AS INT) AS t,
    CAST((vec_id // 5) % 2 AS INT) AS c, CAST(vec_id % 5 AS INT) AS z,
    CAST((pos - 1) // 8 AS INT) AS y, CAST((pos - 1) % 8 AS INT) AS x, CAST(floor((e::DOUBLE + 1) * 32767) AS INT) AS v
    FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS pos FROM embeddings))"""


def rec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as plane records; views and clicks are tiled, every eleventh has no mosaic number."""
    events = table(spark, sf_dir, "events").withColumn("day", F.expr("CAST(date_format(ts, 'yyyyMMdd') AS INT)"))
    begin = events.groupBy("day").agg(F.min("ts").alias("begin_time"))
    number = (
        ("row", "user_id % 8 + 1"), ("column", "user_id % 12 + 1"), ("field_index", "event_id % 4 + 1"), ("time_point", "hour(ts)"), ("ch", "event_id % 2 + 1"),
        ("z_index", "event_id % 3 + 1"), ("timeline_index", "event_id div 5 % 2 + 1"), ("action_index", "event_id div 7 % 2 + 1"),
        ("tile_x_index", "CASE WHEN event_type IN ('view', 'click') THEN event_id % 3 + 1 END"), ("tile_y_index", "CASE WHEN event_type IN ('view', 'click') THEN event_id div 3 % 2 + 1 END"),
        ("partial_tile_index", "CASE WHEN event_type IN ('view', 'click') AND event_id % 11 <> 0 THEN event_id div 6 % 2 + 1 END"),
    )
    return events.join(begin, "day").select(F.col("day").alias("acquisition"), "begin_time", "ts", "event_id", *[F.expr(f"CAST({e} AS INT)").alias(n) for n, e in number], F.col("event_type").alias("action"), "value")


REC = """ev AS (SELECT *, CAST(strftime(ts, '%Y%m%d') AS INT) AS day FROM events),
rec AS (SELECT day AS acquisition, min(ts) OVER (PARTITION BY day) AS begin_time, ts, event_id,
    CAST(user_id % 8 + 1 AS INT) AS "row", CAST(user_id % 12 + 1 AS INT) AS "column", CAST(event_id % 4 + 1 AS INT) AS field_index,
    CAST(hour(ts) AS INT) AS time_point, CAST(event_id % 2 + 1 AS INT) AS ch, CAST(event_id % 3 + 1 AS INT) AS z_index,
    CAST(event_id // 5 % 2 + 1 AS INT) AS timeline_index, CAST(event_id // 7 % 2 + 1 AS INT) AS action_index, event_type AS action,
    CASE WHEN event_type IN ('view', 'click') THEN CAST(event_id % 3 + 1 AS INT) END AS tile_x_index,
    CASE WHEN event_type IN ('view', 'click') THEN CAST(event_id // 3 % 2 + 1 AS INT) END AS tile_y_index,
    CASE WHEN event_type IN ('view', 'click') AND event_id % 11 <> 0 THEN CAST(event_id // 6 % 2 + 1 AS INT) END AS partial_tile_index, value FROM ev)"""
#: The stack keys over ``rec``; %s says which records are kept apart by acquisition.
KEYED = """keyed AS (SELECT * FROM (SELECT *, CASE WHEN tile_x_index IS NULL THEN 'field' ELSE 'tile' END AS kind,
    CASE WHEN tile_x_index IS NULL THEN field_index ELSE partial_tile_index END AS position, CASE WHEN %s THEN acquisition END AS split_acq FROM rec) WHERE position IS NOT NULL)"""
STACK_SQL = '"row", "column", kind, position, timeline_index, action_index, action, split_acq'
