"""A folder of day files as a stream that stops when it has read what is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def day_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def publish_once(stream: DataFrame, out: str, checkpoint: str, check: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Every micro-batch is checked and, if ``check`` finds nothing, written under its own number.

    A batch that runs again after a failure overwrites its own folder and no
    other, so each row is published exactly once. A finding stops the stream.
    """
    from tessera.operators.findings import enforce

    def one(batch: DataFrame, number: int) -> None:
        enforce(check(batch))
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, keys: list[str], *, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Rows per key and window of event time; rows later than the watermark are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("window"), *keys).agg(F.count("*").alias("rows"))
