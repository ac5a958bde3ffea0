"""The experiment registry, a JSON file for each experiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed names: fields of a registry entry.
EXPERIMENT = """experiment_id string, created string, user string, project string, instrument string, modality string, cell_type string, well_type string,
    treatment string, replicate int, prep_date string, labels string, notes string, multi_day boolean, acquisition_date string"""


def read_experiments(spark: SparkSession, root: str) -> DataFrame:
    """Experiments one folder deep, newest first; unreadable files are skipped, a missing ``created`` is the file's time."""
    raw = spark.read.schema(EXPERIMENT).option("multiLine", True).option("mode", "DROPMALFORMED").json(f"{root}/*/metadata.json")
    folder = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1)
    created = F.coalesce("created", F.date_format(F.col("_metadata.file_modification_time"), "yyyy-MM-dd'T'HH:mm:ss"))
    return raw.select(F.url_decode(folder).alias("folder"), *[created.alias(c) if c == "created" else F.col(c) for c in raw.columns]).orderBy(F.desc("created"), "folder")
