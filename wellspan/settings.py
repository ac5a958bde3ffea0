"""Settings: given by name, else from the session (``spark.wellspan.name``), else from the environment (``WELLSPAN_NAME``)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def setting(spark: SparkSession, name: str, given: str | None = None, default: str | None = None) -> str | None:
    if given is not None:
        return given
    found = spark.conf.get(f"spark.wellspan.{name}", None)
    return found if found is not None else os.environ.get(f"WELLSPAN_{name.upper()}", default)
