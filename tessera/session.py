"""What the library needs of a session."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def make_importable(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver did, if it was not shipped to them otherwise."""
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = [x for x in environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if x]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
