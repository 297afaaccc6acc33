"""Tab-separated pages: exact header, exact width, strict escapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.errors import FindingError

#: Escape letter and the byte it stands for; any other escape, and raw control bytes, are refused.
_LETTERS = {"b": "\b", "f": "\f", "r": "\r", "n": "\n", "t": "\t", "0": "\0", "'": "'", "\\": "\\"}


def field_reason(c: Column) -> Column:
    r"""Why an encoded field is refused; ``\N`` is null, and only as a whole field."""
    escapes_ok = c.rlike(r"(?s)^([^\\\x00-\x1F]|\\[bfrnt0'\\])*\z")
    return F.when((c != "\\N") & ~escapes_ok, F.lit("illegal escape or raw control byte"))


def decode_field(c: Column) -> Column:
    r"""The text of an encoded field; null for ``\N``. A mark no field can hold stands for ``\\`` meanwhile."""
    out = F.replace(c, F.lit("\\\\"), F.lit("\x01"))
    for letter, byte in _LETTERS.items():
        if letter != "\\":
            out = F.replace(out, F.lit("\\" + letter), F.lit(byte))
    return F.when(c != "\\N", F.replace(out, F.lit("\x01"), F.lit("\\")))


def read_pages(spark: SparkSession, path: str, header: list[str], *, max_field_bytes: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """(rows, findings) of all pages below a path.

    Rows: file, row and the decoded columns. Findings: file, row, column,
    reason for a wrong width, a long field or an illegal one; such rows are not
    among the rows. Every file must begin with the header.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value")
    first = lines.groupBy("file").agg(F.min_by("value", F.struct("block", "line")).alias("header"))
    want = "\t".join(header)
    if wrong := first.filter(F.col("header") != want).limit(1).collect():
        raise FindingError(f"{wrong[0]['file']}: another header")
    starts = lines.groupBy("file").agg(F.min(F.struct("block", "line")).alias("start"))
    body = lines.join(F.broadcast(starts), "file").filter(F.struct("block", "line") != F.col("start"))
    split = body.select("file", F.col("line").alias("row"), F.split("value", "\t", -1).alias("f"))
    wide = F.size("f") == len(header)
    reasons = F.array(*(F.struct(F.lit(n).alias("column"), F.coalesce(F.when(F.octet_length(F.get("f", F.lit(i))) > max_field_bytes, F.lit("field too long")), field_reason(F.get("f", F.lit(i)))).alias("reason")) for i, n in enumerate(header)))
    bad = F.when(~wide, F.array(F.struct(F.lit("").alias("column"), F.lit("wrong width").alias("reason")))).otherwise(F.filter(reasons, lambda r: r["reason"].isNotNull()))
    checked = split.withColumn("bad", bad)
    findings = checked.select("file", "row", F.explode("bad").alias("b")).select("file", "row", "b.column", "b.reason")
    rows = checked.filter(F.size("bad") == 0).select("file", "row", *(decode_field(F.get("f", F.lit(i))).alias(n) for i, n in enumerate(header)))
    return rows, findings
