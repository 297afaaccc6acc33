"""Total order, keyset pages, and pages that never part a key group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.errors import FindingError


def total_order(columns: list[str], cursor: list[str]) -> list[Column]:
    """The cursor, then every other column, ascending with nulls last, so that the order has no ties but equal rows."""
    return [F.col(c).asc_nulls_last() for c in [*cursor, *(c for c in columns if c not in cursor)]]


def after(cursor: list[str], values: list) -> Column:
    """Rows whose cursor is greater, in a form that reaches the file's statistics: a > x or (a = x and (b > y ...))."""
    tests = [(F.col(c), F.lit(v)) for c, v in zip(cursor, values, strict=True)]
    found = tests[-1][0] > tests[-1][1]
    for c, v in reversed(tests[:-1]):
        found = (c > v) | ((c == v) & found)
    return found


def in_group(cursor: list[str], values: list) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c) == F.lit(v) for c, v in zip(cursor, values, strict=True)))


def page(df: DataFrame, cursor: list[str], rows: int, start: list | None = None) -> DataFrame:
    """The next ``rows`` rows after a cursor; a top-k, so no full sort."""
    source = df if start is None else df.filter(after(cursor, start))
    return source.orderBy(*total_order(df.columns, cursor)).limit(rows)


def rows_per_page(total_bytes: int, total_rows: int, budget: int, most: int = 1_000_000) -> int:
    """Rows that fit a byte budget at the table's mean row size."""
    return max(1, min(most, budget // max(1, total_bytes // max(1, total_rows))))


def group_starts(df: DataFrame, cursor: list[str]) -> DataFrame:
    """cursor columns, size, start: each key group's rows and the number of rows before it in key order.

    Groups are counted first; their places come from one running sum per range
    of keys and the ranges' totals, so no task orders the whole table.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = df.groupBy(*cursor).agg(F.count("*").alias("size")).repartitionByRange(parts, *(F.col(c).asc_nulls_last() for c in cursor))
    groups = groups.withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy("_part").orderBy(*(F.col(c).asc_nulls_last() for c in cursor)).rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    totals = groups.groupBy("_part").agg(F.sum("size").alias("_total"))
    base = totals.withColumn("_base", F.coalesce(F.sum("_total").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return placed.join(F.broadcast(base.select("_part", "_base")), "_part").select(*cursor, "size", (F.col("_base") + F.col("_before")).alias("start"))


def assign_pages(df: DataFrame, cursor: list[str], rows: int, *, widest: int | None = None) -> DataFrame:
    """``df`` with ``page``: pages of about ``rows`` rows in key order; a group belongs to the page of its first row.

    So a page may be longer by the rest of its last group. A group of more than
    ``widest`` rows is a finding.
    """
    starts = group_starts(df, cursor)
    if widest is not None and (wide := starts.filter(F.col("size") > widest).limit(1).collect()):
        raise FindingError(f"a key group has {wide[0]['size']} rows, more than {widest}")
    paged = starts.select(*(F.col(c).alias(f"_{c}") for c in cursor), F.floor(F.col("start") / rows).alias("page"))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cursor))
    return df.join(paged, same).drop(*(f"_{c}" for c in cursor))


def page_summary(paged: DataFrame, cursor: list[str]) -> DataFrame:
    """page, rows, last cursor, rows of the last key group: what the next page starts from."""
    key = F.struct(*cursor)
    groups = paged.groupBy("page", *cursor).agg(F.count("*").alias("n"))
    return groups.groupBy("page").agg(F.sum("n").alias("rows"), F.max(key).alias("last"), F.max_by("n", key).alias("tail"))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` of a Parquet scan with file_name and row (from 1) as stored; no shuffle."""
    return df.withColumns({"file_name": F.col("_metadata.file_name"), "row": F.col("_metadata.row_index") + 1})


def file_numbers(files: DataFrame) -> DataFrame:
    """date, path and the file's place among the paths of its date, from 0."""
    return files.withColumn("file", F.dense_rank().over(Window.partitionBy("date").orderBy("path")) - 1)


def adjacent_duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
