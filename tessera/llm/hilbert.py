"""Sharding along a Hilbert curve over several metadata dimensions, for files that can be pruned by any of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._work import Workspace


_HASHED = ("string", "boolean", "date", "binary")


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers (n rows, d dimensions of ``bits`` bits each)."""
    x = cells.astype(np.int64).T.copy()
    d, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        for i in range(d):
            far = (x[i] & q) != 0
            swap = np.where(far, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(far, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip, q = np.zeros_like(x[0]), top
    while q > 1:
        flip ^= np.where(x[d - 1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _hashed(c: Column, bits: int) -> Column:
    return F.when(c.isNull(), 0).otherwise(F.pmod(F.xxhash64(c), F.lit(1 << bits))).cast("int")


def hilbert_order(df: DataFrame, dimensions: list[str], *, bits: int = 8) -> DataFrame:
    """``df`` with ``curve``, the place of each row's cell on the curve.

    The cell of a number is its place among quantiles of all rows, of text a
    hash; null is in cell 0.
    """
    kinds = dict(df.dtypes)
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [c for c in dimensions if kinds[c] not in _HASHED]
    found = df.agg(*(F.percentile_approx(F.col(c).cast("double"), steps, 10_000).alias(c) for c in numbers)).first() if numbers else {}
    cuts = [np.unique(found[c] or []) if c in numbers else None for c in dimensions]

    @F.pandas_udf("long")
    def place(values: pd.DataFrame) -> pd.Series:
        cells = [values.iloc[:, i].to_numpy() if cut is None else np.where(values.iloc[:, i].isna(), 0, np.searchsorted(cut, values.iloc[:, i], side="right")) for i, cut in enumerate(cuts)]
        return pd.Series(hilbert_index(np.column_stack(cells), bits))

    values = [F.col(c).cast("double") if c in numbers else _hashed(F.col(c), bits) for c in dimensions]
    return df.withColumn("curve", place(F.struct(*(v.alias(f"c{i}") for i, v in enumerate(values)))))


def cut_runs(ordered: DataFrame, order: list[str], shards: int, work: Workspace) -> DataFrame:
    """``ordered`` with shard and slot: runs in the given order whose row counts differ by one at most.

    Ranges of the order go to tasks, which number their rows; one row count per
    task gives the global place. No step holds more than a task's range.
    """
    spark = ordered.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part, row = F.spark_partition_id(), F.monotonically_increasing_id()
    dealt = ordered.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumns({"_part": part, "_row": row.bitwiseAND((1 << 33) - 1)})
    dealt = work.keep(dealt, "dealt")
    counts = sorted((r["_part"], r["count"]) for r in dealt.groupBy("_part").count().collect())
    total, before, rows = sum(n for _, n in counts), 0, []
    for p, n in counts:
        rows.append((p, before))
        before += n
    base = spark.createDataFrame(rows, "_part int, _base long")
    size, larger = divmod(total, shards)
    at = F.col("_base") + F.col("_row")
    in_larger = at < larger * (size + 1)
    rest = at - larger * (size + 1)
    shard = F.when(in_larger, F.floor(at / (size + 1))).otherwise(larger + F.floor(rest / max(size, 1))).cast("int")
    slot = F.when(in_larger, at % (size + 1)).otherwise(rest % max(size, 1)).cast("long")
    return dealt.join(F.broadcast(base), "_part").withColumns({"shard": shard, "slot": slot}).drop("_part", "_base", "_row")


def shard_documents(docs: DataFrame, *, shards: int = 16, bits: int = 8) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, curve.

    Dimensions are lang, source and the text's size. Law "rows": shards are
    runs of the curve whose row counts differ by one at most. Rows of one cell
    are ordered by text checksum, then doc_id, so copies lie together. Null
    text has size 1 and the checksum of no bytes; null metadata takes cell 0;
    a null doc_id sorts first; repeated rows each get a slot; an empty table
    gives no rows. Other columns of ``docs`` are not read.
    """
    work = Workspace(docs.sparkSession, "shards")
    text = F.coalesce("text", F.lit(""))
    facts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), "lang", "source")
    facts = work.keep(facts, "facts")
    ordered = hilbert_order(facts, ["lang", "source", "size"], bits=bits)
    cut = cut_runs(ordered, ["curve", "text_crc32", "doc_id"], shards, work)
    return cut.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(df: DataFrame, dimensions: list[str], out: str, *, shards: int = 16, bits: int = 8) -> DataFrame:
    """Write all rows of ``df`` as Parquet, one folder per shard, in curve order; return the manifest.

    The manifest has one row per shard: its number of rows and, per dimension,
    the least and greatest value and the hashed cells that occur (2**bits at
    most), by which :func:`prune` finds the folders to read. Rows of one cell
    are ordered by their hash, so that a crowded cell is dealt over tasks.

    Every column is written, whatever its name; only ``shard`` is refused, for
    it names the folders. A null dimension is in cell 0; repeated rows are all
    written; an empty table writes no folder and gives an empty manifest.
    """
    if "shard" in (c.lower() for c in df.columns):
        raise ValueError("a column named shard would be lost to the folders' names")
    work = Workspace(df.sparkSession, "shards")
    own = {c: f"d{i}" for i, c in enumerate(dimensions)}
    whole = [F.col(f"`{c}`") for c in df.columns]
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    packed = df.select(F.struct(*whole).alias("row"), F.xxhash64(*hashed).alias("tie"), *(F.col(f"`{c}`").alias(d) for c, d in own.items()))
    cut = cut_runs(hilbert_order(packed, list(own.values()), bits=bits), ["curve", "tie"], shards, work)
    cut.sortWithinPartitions("shard", "slot").select("row.*", "shard").write.partitionBy("shard").parquet(out)
    stats = [f(d).alias(f"{n}_{c}") for c, d in own.items() for n, f in (("min", F.min), ("max", F.max))]
    cells = [F.collect_set(_hashed(F.col(d), bits)).alias(f"cells_{c}") for c, d in own.items() if dict(df.dtypes)[c] in _HASHED]
    return work.keep(cut.groupBy("shard").agg(F.count("*").alias("n_rows"), *stats, *cells), "manifest")


def prune(manifest: DataFrame, *, bits: int = 8, **wanted) -> list[int]:
    """Shards that may hold rows with all the wanted values (a value, or a (least, greatest) pair)."""
    for c, v in wanted.items():
        low, high = v if isinstance(v, tuple) else (v, v)
        manifest = manifest.filter((F.col(f"min_{c}") <= high) & (F.col(f"max_{c}") >= low))
        if not isinstance(v, tuple) and f"cells_{c}" in manifest.columns:
            manifest = manifest.filter(F.array_contains(f"cells_{c}", _hashed(F.lit(v), bits)))
    return sorted(r.shard for r in manifest.select("shard").collect())
