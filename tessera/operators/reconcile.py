"""Do two reads, a ledger and its pages, a manifest and its files say the same?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.errors import FindingError


def difference(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows, with multiplicity, that one read has and the other has not; ``read`` says which. One shuffle for both."""
    columns = first.columns
    tagged = first.withColumn("_d", F.lit(1)).unionByName(second.withColumn("_d", F.lit(-1)))
    net = tagged.groupBy(*columns).agg(F.sum("_d").alias("_d")).filter("_d != 0")
    return net.select(*columns, F.when(F.col("_d") > 0, "first").otherwise("second").alias("read"), F.abs("_d").alias("n"))


def reconcile_counts(streamed: int, counted: int, stored: int) -> None:
    """A read must give as many rows as were counted, and no more than are stored."""
    if streamed != counted:
        raise FindingError(f"read {streamed} rows, counted {counted}")
    if streamed > stored:
        raise FindingError(f"read {streamed} rows, stored {stored}")


def field_mismatches(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field, left, right wherever two relations differ in a field, or one lacks the key."""
    a = left.select(F.col(key), F.lit(True).alias("_l"), *(F.col(f).cast("string").alias(f"l_{f}") for f in fields))
    b = right.select(F.col(key), F.lit(True).alias("_r"), *(F.col(f).cast("string").alias(f"r_{f}") for f in fields))
    joined = a.join(b, key, "full_outer")
    cells = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"l_{f}").alias("left"), F.col(f"r_{f}").alias("right")) for f in fields))
    gone = F.col("_l").isNull() | F.col("_r").isNull()
    return joined.select(key, gone.alias("gone"), F.explode(cells).alias("c")).filter(F.col("gone") | ~F.col("c.left").eqNullSafe(F.col("c.right"))).select(key, "c.field", "c.left", "c.right")


def not_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "left_anti")


def same_inventory(published: DataFrame, current: DataFrame, keys: list[str]) -> None:
    """Published sources and the inventory must match exactly, or a published partition is not reused."""
    for kind, gone in (("missing from the inventory", not_in(published, current, keys)), ("not published", not_in(current, published, keys))):
        if rows := gone.limit(1).collect():
            raise FindingError(f"{kind}: {tuple(rows[0][k] for k in keys)}")
