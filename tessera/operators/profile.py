"""Shapes of columns: exact, and by mergeable sketches for tables too wide for exact distinct counts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def long_form(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, value (text) of every cell; one scan for all columns."""
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))
    return df.select(F.explode(cells).alias("c")).select("c.column", "c.value")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return long_form(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))


def exact_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows, nulls, null_rate, distinct, min and max length in bytes and value, whether it is constant.

    Values are counted first (partial sums before the shuffle), so that distinct
    counts need no second pass and no state per group beyond numbers.
    """
    counts = value_counts(df, columns)
    there = F.col("value").isNotNull()
    stats = counts.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(there, 0).otherwise(F.col("n"))).alias("nulls"),
        F.count("value").alias("distinct"),
        F.coalesce(F.min(F.octet_length("value")), F.lit(0)).alias("min_len"),
        F.coalesce(F.max(F.octet_length("value")), F.lit(0)).alias("max_len"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )
    return stats.withColumn("null_rate", F.when(F.col("rows") > 0, F.col("nulls") / F.col("rows")).otherwise(0.0)).withColumn("constant", (F.col("distinct") <= 1) & (F.col("rows") > 1))


def top_values(df: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """column, rank, value, n: the k most frequent values, ties by value; the limit per column applies before the shuffle."""
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return value_counts(df, columns).filter(F.col("value").isNotNull()).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def duplicate_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """rows, distinct_rows, duplicate_rows over all the columns; null equals null only."""
    groups = df.groupBy(*columns).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def kmv_distinct(df: DataFrame, columns: list[str], k: int = 256) -> DataFrame:
    """Per column: rows, nulls, estimate of distinct values from the k smallest distinct hashes, at most the non-null rows.

    The k smallest are taken per task before the shuffle. With fewer than k distinct values the count is exact.
    """
    cells = long_form(df, columns)
    base = cells.groupBy("column").agg(F.count("*").alias("rows"), F.sum(F.col("value").isNull().cast("int")).alias("nulls"))
    hashes = cells.filter("value is not null").select("column", F.xxhash64("value").alias("h")).groupBy("column", "h").agg(F.count("*").alias("n"))
    small = hashes.withColumn("r", F.row_number().over(Window.partitionBy("column").orderBy("h"))).filter(F.col("r") <= k)
    kept = small.groupBy("column").agg(F.count("*").alias("kept"), F.max("h").alias("greatest"))
    share = (F.col("greatest").cast("double") + 2.0**63) / 2.0**64
    estimate = F.when(F.col("kept") < k, F.col("kept")).otherwise(F.round((k - 1) / share).cast("long"))
    return base.join(kept, "column", "left").select("column", "rows", "nulls", F.coalesce(F.least(estimate, F.col("rows") - F.col("nulls")), F.lit(0)).cast("long").alias("distinct_estimate"))


def frequent_values(df: DataFrame, columns: list[str], counters: int = 16) -> DataFrame:
    """column, value, count, overcount by space-saving sketches, one per task and column, merged per column.

    ``count`` is never below the true one and at most ``overcount`` above it;
    every value more frequent than rows / counters is there. A task's sketch
    that is full may have seen any value that it lacks as often as its least
    count, so that much is added for each sketch without the value.
    """
    schema = "column string, value string, count long, overcount long, floor long"
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())

    def add(table: dict, value: str, count: int) -> None:
        if value in table or len(table) < counters:
            c, o = table.get(value, (0, 0))
            table[value] = (c + count, o)
        else:
            c, _ = table.pop(min(table, key=lambda v: (table[v][0], v)))
            table[value] = (c + count, c)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: list[dict] = [{} for _ in columns]
        for batch in batches:
            for i, table in enumerate(tables):
                for pair in batch.column(i).value_counts().to_pylist():
                    if pair["values"] is not None:
                        add(table, pair["values"], pair["counts"])
        rows = []
        for column, table in zip(columns, tables, strict=True):
            floor = min(c for c, _ in table.values()) if len(table) == counters else 0
            rows += [(column, None, 0, 0, floor)] + [(column, v, c - floor, o - floor, 0) for v, (c, o) in table.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], names=["column", "value", "count", "overcount", "floor"])

    partial = df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in columns)).mapInArrow(sketch, schema)
    # One aggregation for both: the row without a value has the sum of all floors.
    sums = partial.groupBy("column", "value").agg(F.sum("count").alias("count"), F.sum("overcount").alias("overcount"), F.sum("floor").alias("floor"))
    whole = Window.partitionBy("column")
    full = sums.withColumn("floor", F.max("floor").over(whole)).filter("value is not null")
    full = full.select("column", "value", (F.col("count") + F.col("floor")).alias("count"), (F.col("overcount") + F.col("floor")).alias("overcount"))
    rank = F.row_number().over(whole.orderBy(F.desc("count"), "value"))
    return full.withColumn("rank", rank).filter(F.col("rank") <= counters).drop("rank")


def content_checksum(df: DataFrame) -> DataFrame:
    """rows and an order-free checksum over all columns, by which two reads of a table compare."""
    row = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("xor"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("sum"))
