"""Facts of Parquet footers, and guards on them before any data page is read."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACTS = "path string, bytes long, footer_bytes long, rows long, group_rows long, row_groups int, columns int, uncompressed long, external boolean, created_by string, schema string, error string"


def footer_facts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: sizes, row counts of the file and of its row groups, schema text, or why the footer can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    if content[:4] != b"PAR1" or content[-4:] != b"PAR1":
                        raise ValueError("no Parquet magic at both ends")
                    size = int.from_bytes(content[-8:-4], "little")
                    meta = pq.ParquetFile(io.BytesIO(content)).metadata
                    groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
                    chunks = [g.column(j) for g in groups for j in range(g.num_columns)]
                    rows.append((path, len(content), size, meta.num_rows, sum(g.num_rows for g in groups), len(groups), meta.num_columns, sum(c.total_uncompressed_size for c in chunks), any(c.file_path for c in chunks), meta.created_by, str(meta.schema.to_arrow_schema().remove_metadata()), None))
                except (ValueError, OSError, pa.ArrowException) as e:
                    rows.append((path, len(content), *[None] * 9, str(e)))
            kinds = (pa.string(), *[pa.int64()] * 4, pa.int32(), pa.int32(), pa.int64(), pa.bool_(), *[pa.string()] * 3)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=[x.split()[0] for x in FACTS.split(", ")])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, FACTS)


def guard(facts: DataFrame, *, max_footer: int = 8 << 20, max_uncompressed: int = 1 << 40, max_ratio: int = 1000) -> DataFrame:
    """path, reason of every file that breaks a cap."""
    reason = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("footer_bytes") > max_footer, "footer too large")
        .when(F.col("rows") != F.col("group_rows"), "row counts disagree")
        .when(F.col("external"), "column data in another file")
        .when(F.col("uncompressed") > max_uncompressed, "too much data")
        .when(F.col("uncompressed") > F.col("bytes") * max_ratio, "unfolds into too much")
    )
    return facts.select("path", reason.alias("reason")).filter("reason is not null")


def narrow_integers(df: DataFrame, bounds: dict[str, tuple[int, int]]) -> DataFrame:
    """column, rows, least, greatest where stored integers pass the width that their annotation promises.

    ``df`` reads those columns in their physical width.
    """
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("v"), F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi")) for c, (lo, hi) in bounds.items()))
    bad = df.select(F.explode(cells).alias("x")).filter("x.v < x.lo or x.v > x.hi")
    return bad.groupBy("x.column").agg(F.count("*").alias("rows"), F.min("x.v").alias("least"), F.max("x.v").alias("greatest"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """path, length and SHA-256 of every file."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))
