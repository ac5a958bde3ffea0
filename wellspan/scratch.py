"""A scratch folder that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """A folder of the application below ``spark.checkpoint.dir``; a local one only in a local session without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        key = spark.sparkContext.applicationId
        if key not in _LOCAL:
            _LOCAL[key] = tempfile.mkdtemp(prefix="wellspan-")
        root = _LOCAL[key]
    return f"{root.rstrip('/')}/wellspan-core-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table to the scratch folder and read it back: run once, however often it is used."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
