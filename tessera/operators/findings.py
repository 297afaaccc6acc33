"""The findings relation and its aggregates."""

from __future__ import annotations

from collections.abc import Callable, Collection
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.contracts import ColumnContract, Limits
from tessera.errors import FindingError
from tessera.functions.payloads import decoded_scan, may_hold, once, raw_classes, sample_hex
from tessera.functions.validators import column_reason, nested, texts_in, walk_reason

#: One row per finding, the same for every check.
FINDINGS = "phase string, column string, file int, row long, reason string, escalate boolean, sample_hex string, classes array<string>, via array<string>"


def _entry(contract: ColumnContract, c: Column, via: Column) -> Callable[[Column], Column]:
    """What makes the finding of a value out of (reason, found); null without one."""
    none = F.array().cast("array<string>")

    def entry(x: Column) -> Column:
        classes = F.coalesce(x["found"], none)
        why = F.coalesce(x["reason"], F.when(F.size(classes) > 0, F.concat(F.lit("payload: "), F.array_join(classes, ","))))
        made = F.struct(
            F.when(x["reason"].isNull(), "payload").otherwise("contract").alias("phase"),
            F.lit(contract.name).alias("column"),
            why.alias("reason"),
            F.lit(contract.freedom != "open").alias("escalate"),
            sample_hex(c.cast("string")).alias("sample_hex"),
            classes.alias("classes"),
            F.when(F.size(classes) > 0, via).otherwise(none).alias("via"),
        )
        return F.when(why.isNotNull(), made)

    return entry


def audit(df: DataFrame, columns: list[ColumnContract], key: Column, *, file: Column | None = None, text: bool = True, scan: bool = True, limits: Limits | None = None, iocs: tuple[str, ...] = ()) -> DataFrame:
    """Findings of every value that breaks its contract or, being text, holds a payload; one at most per value.

    One pass: each row makes an array with an entry per column, and only
    entries with a reason are unfolded. ``key`` numbers the rows. A finding in
    an open column does not escalate. Dropped columns are not read.

    With ``limits`` text is also scanned in its decoded forms, as many rounds
    and bytes deep as they say, values beyond their byte cap are findings, and
    so is a value that unfolds into more than they allow; arrays, maps and
    structs are walked into, their elements counted, and every text in them
    checked. Without, text is scanned as it stands. ``iocs`` are literals of an
    incident that count as payloads.
    """
    extra = {"ioc_canary": list(iocs)} if iocs else None
    kept = [c for c in columns if not c.drop]
    names = fresh(df, *(f"decoded_{i}" for i in range(len(kept))))
    file_name, row_name = fresh(df, "finding_file", "finding_row")
    # Set before any row goes, for a key may count rows.
    df = df.withColumns({file_name: (F.lit(0) if file is None else file).cast("int"), row_name: key.cast("long")})
    entries, asked, doubts = [], {}, []
    for contract, name in zip(kept, names, strict=True):
        c = F.col(f"`{contract.name}`")
        leaf = contract.declared
        leaf = leaf.inner[0] if leaf.name in ("Nullable", "LowCardinality") else leaf
        tests = [column_reason(c, contract, text=text)]
        kind = df.schema[contract.name].dataType
        scanned = scan and (text or leaf.name == "String")
        if limits is not None:
            if nested(kind):
                tests.append(walk_reason(c, kind, limits))
            elif scanned:
                tests.append(F.when(F.octet_length(c.cast("string")) > limits.max_field_bytes, "too long"))
        reason = F.coalesce(*tests)
        value = texts_in(c, kind) if nested(kind) else c.cast("string")
        doubt = reason.isNotNull()
        found, via = F.lit(None).cast("array<string>"), F.array(F.lit("raw"))
        if scan and (scanned or nested(kind)):
            found = raw_classes(value, extra)
            if limits is not None:
                # Only values that are still in question go to Python; one that is too long is a finding already.
                asked[name] = decoded_scan(F.when(reason.isNull(), value), rounds=limits.max_decode_rounds, ratio=limits.max_decode_expansion_ratio, extra=extra)
                doubt = doubt | F.coalesce(F.lit(True) if iocs else may_hold(value), F.lit(False))
                deep = F.col(name)
                reason = F.coalesce(reason, F.when(deep["over_budget"], "decodes into too much"))
                found, via = deep["classes"], deep["via"]
        doubts.append(doubt)
        exempt = c.isin(*contract.approved) if contract.approved else F.lit(False)
        judged = F.struct(reason.alias("reason"), F.when(reason.isNull() & c.isNotNull() & ~exempt, found).alias("found"))

        entries.append(once(judged, _entry(contract, c, via)))
    if asked:
        # Rows without a reason and with nothing to decode never go to Python.
        df = df.filter(reduce(or_, doubts)).withColumns(asked)
    hits = F.filter(F.array(*entries), lambda e: e.isNotNull())
    unfolded = df.select(F.col(file_name).alias("file"), F.col(row_name).alias("row"), F.explode_outer(hits).alias("f")).filter("f is not null")
    return unfolded.select("f.phase", "f.column", "file", "row", "f.reason", "f.escalate", "f.sample_hex", "f.classes", "f.via")


def payload_findings(df: DataFrame, columns: list[str], key: Column, only: Collection[str] | None = None) -> DataFrame:
    """column, row, class, sample_hex of every payload class, or of those in ``only``, in the raw text of the columns."""
    parts = F.array(*(F.struct(F.lit(c).alias("column"), raw_classes(F.col(c), only=only).alias("classes"), sample_hex(F.col(c)).alias("sample_hex")) for c in columns))
    hits = df.select(key.alias("row"), F.explode(parts).alias("p")).filter(F.size("p.classes") > 0)
    return hits.select("p.column", "row", F.explode("p.classes").alias("class"), "p.sample_hex")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be no column of the frame."""
    taken = {c.lower() for c in df.columns}
    for _ in range(len(taken) + 1):
        names = tuple(f"_{n}" if n.lower() in taken else n for n in names)
    return list(names)


def by_reason(findings: DataFrame) -> DataFrame:
    """column, reason, findings, and distinct rows with them."""
    return findings.groupBy("column", "reason").agg(F.count("*").alias("findings"), F.count_distinct("file", "row").alias("rows"))


def inventory(findings: DataFrame, samples: int = 5) -> DataFrame:
    """Per column: rows with findings, reasons in order of first sight, the first samples.

    Reasons and samples are picked by aggregation with a bound per column, never by gathering all of a column's findings.
    """
    rows = findings.groupBy("column").agg(F.count_distinct("file", "row").alias("rows"))
    seen = findings.groupBy("column", "reason").agg(F.min(F.struct("file", "row")).alias("at"))
    reasons = seen.groupBy("column").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "reason"))), lambda x: x["reason"]).alias("reasons"))
    first = Window.partitionBy("column").orderBy("file", "row", "reason")
    picked = findings.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= samples)
    shown = picked.groupBy("column").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "sample_hex"))), lambda x: x["sample_hex"]).alias("samples"))
    return rows.join(reasons, "column").join(shown, "column")


def capped_samples(findings: DataFrame, most_bytes: int = 1 << 20) -> DataFrame:
    """Findings in (file, row, column) order as long as their samples fit a budget per column; counts stay exact elsewhere."""
    running = Window.partitionBy("column").orderBy("file", "row").rowsBetween(Window.unboundedPreceding, 0)
    return findings.withColumn("_sum", F.sum(F.coalesce(F.octet_length("sample_hex"), F.lit(0))).over(running)).filter(F.col("_sum") <= most_bytes).drop("_sum")


def enforce(findings: DataFrame) -> None:
    """Stop at any finding; the first by (file, row, column) is reported."""
    if first := findings.orderBy("file", "row", "column").limit(1).collect():
        raise FindingError(f"{first[0]['column']}, file {first[0]['file']}, row {first[0]['row']}: {first[0]['reason']}")
