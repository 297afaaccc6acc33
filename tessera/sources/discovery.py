"""Which files make which day of which table."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.errors import FindingError, UsageError


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """path, length, modified of all Parquet files below a root, contents unread."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def dates(spark: SparkSession, first: datetime.date, last: datetime.date, most: int = 36_600) -> DataFrame:
    """Every day from first to last."""
    if not 0 <= (last - first).days < most:
        raise UsageError("dates are in order and at most 36600 days apart")
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))


def discover(files: DataFrame, root: str, *, max_tables: int = 256) -> DataFrame:
    """table, date, path, file (place in its day) for the layout ``table/YYYY/MM/DD/name.parquet``.

    Another depth, a date that is none or not zero-padded, or too many tables is a finding.
    """
    parts = F.split(F.expr(f"substring(path, {len(root.rstrip('/')) + 2})"), "/")
    placed = files.select("path", parts.alias("p"), F.try_to_date(F.concat_ws("-", F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.get(parts, F.lit(3))), "yyyy-MM-dd").alias("date"))
    shaped = (F.size("p") == 5) & F.col("date").isNotNull() & F.get("p", F.lit(1)).rlike("^[0-9]{4}$") & F.get("p", F.lit(2)).rlike("^[0-9]{2}$") & F.get("p", F.lit(3)).rlike("^[0-9]{2}$")
    if wrong := placed.filter(~F.coalesce(shaped, F.lit(False))).limit(1).collect():
        raise FindingError(f"{wrong[0]['path']}: not table/YYYY/MM/DD/name.parquet")
    out = placed.select(F.get("p", F.lit(0)).alias("table"), "date", "path")
    if out.select("table").distinct().limit(max_tables + 1).count() > max_tables:
        raise FindingError(f"more than {max_tables} tables")
    if twice := out.groupBy("path").count().filter("count > 1").limit(1).collect():
        raise FindingError(f"{twice[0]['path']} is listed twice")
    from pyspark.sql import Window

    return out.withColumn("file", F.row_number().over(Window.partitionBy("table", "date").orderBy("path")) - 1)


def day_prefix(table: str, date: datetime.date, layout: str = "table/date") -> str:
    day = date.strftime("%Y/%m/%d")
    return f"{table}/{day}" if layout == "table/date" else f"{day}/{table}"


def exclude(partitions: DataFrame, excluded: DataFrame, keys: list[str]) -> DataFrame:
    """Partitions but the excluded ones; an exclusion that names no partition is a usage error."""
    if typo := excluded.join(partitions, keys, "left_anti").limit(1).collect():
        raise UsageError(f"excluded, but not there: {tuple(typo[0][k] for k in keys)}")
    return partitions.join(excluded, keys, "left_anti")
