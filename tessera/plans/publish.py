"""Publishing an audited table: nothing before every check has passed, the manifest last."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.contracts import TableContract
from tessera.errors import AuditError, FindingError, UsageError
from tessera.operators import findings as found
from tessera.operators.profile import content_checksum, exact_profile

#: Session settings a run needs, for results to mean the same everywhere.
SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.files.ignoreCorruptFiles": "false", "spark.sql.files.ignoreMissingFiles": "false"}
STATES = ("complete", "failed", "interrupted", "reused")


def pin(spark: SparkSession) -> None:
    known = {r.key for r in spark.sql("SET -v").select("key").collect()}
    if missing := [k for k in SETTINGS if k not in known]:
        raise UsageError(f"unknown settings: {', '.join(missing)}")
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)


def with_provenance(df: DataFrame, source: str, sha256: str, contract: TableContract) -> DataFrame:
    """Where each row came from and under which contract it was checked."""
    for name in ("_source", "_source_sha256", "_contract"):
        if name in df.columns:
            raise FindingError(f"{name} is a column already")
    return df.withColumns({"_source": F.lit(source), "_source_sha256": F.lit(sha256), "_contract": F.lit(contract.digest)})


def _filesystem(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text_once(spark: SparkSession, uri: str, text: str) -> None:
    """Write a small document under another name and rename it; one that exists must be equal."""
    path, fs = _filesystem(spark, uri)
    if fs.exists(path):
        have = "\n".join(r.value for r in spark.read.text(uri).collect())
        if have.rstrip("\n") != text.rstrip("\n"):
            raise FindingError(f"{uri} exists and differs")
        return
    part, _ = _filesystem(spark, uri + ".partial")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, path):
        raise FindingError(f"{uri} could not be put in place")


def regenerate(df: DataFrame, out: str, *, rows_per_file: int = 5_000_000) -> None:
    """Create-only Parquet with bounded files; an empty table still leaves its schema."""
    df.write.mode("errorifexists").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(out)


def publish(df: DataFrame, contract: TableContract, raw: str, out: str, *, key, source: str = "", sha256: str = "", signed_off: bool = False, survey: bool = False) -> dict:
    """Audit within the contract's limits, decoded forms too, and unless anything is found write the data, read it back, and write report and manifest.

    ``survey`` returns the inventory and writes nothing. Enforcing needs a
    sign-off and a destination other than the source.
    """
    spark = df.sparkSession
    if raw.rstrip("/") == out.rstrip("/"):
        raise UsageError("the clean destination is the raw source")
    if not survey and not signed_off:
        raise UsageError("publishing needs a sign-off")
    hits = found.audit(df, list(contract.kept), key, text=False, limits=contract.limits, iocs=contract.iocs)
    if survey:
        return {"state": "survey", "inventory": [r.asDict(recursive=True) for r in found.inventory(hits).orderBy("column").collect()]}
    found.enforce(hits)
    kept = df.select(*(c.name for c in contract.kept))
    before = content_checksum(kept).first()
    regenerate(with_provenance(kept, source, sha256, contract), f"{out}/data")
    after = content_checksum(spark.read.parquet(f"{out}/data").select(*kept.columns)).first()
    if before != after:
        raise FindingError("what was written reads back differently")
    profile = [r.asDict() for r in exact_profile(kept, kept.columns).orderBy("column").collect()]
    write_text_once(spark, f"{out}/report.json", json.dumps({"findings": 0, "profile": profile}, sort_keys=True, default=str))
    manifest = {"table": contract.table, "contract": contract.digest, "rows": before["rows"], "checksum": [before["xor"], before["sum"]], "columns": [c.name for c in contract.kept], "rejected": {}, "state": "complete"}
    write_text_once(spark, f"{out}/manifest.json", json.dumps(manifest, sort_keys=True))
    return manifest


def published(spark: SparkSession, out: str) -> dict | None:
    """The manifest of a finished publication; without one nothing there counts."""
    path, fs = _filesystem(spark, f"{out}/manifest.json")
    return json.loads("\n".join(r.value for r in spark.read.text(f"{out}/manifest.json").collect())) if fs.exists(path) else None


def run_partitions(partitions: list[tuple[str, object]], reusable, work) -> dict[str, str]:
    """State of each (name, partition): reused if ``reusable`` says so; after a failure the rest is interrupted."""
    states: dict[str, str] = {}
    stopped = False
    for name, part in partitions:
        if stopped:
            states[name] = "interrupted"
        elif reusable(name, part):
            states[name] = "reused"
        else:
            try:
                work(name, part)
                states[name] = "complete"
            except AuditError:
                states[name], stopped = "failed", True
    return states


def rollup(states: DataFrame) -> DataFrame:
    """table, state, partitions, rows, with totals per table and over all."""
    return states.rollup("table", "state").agg(F.count("*").alias("partitions"), F.sum("rows").alias("rows"))


def shape_review(profile: DataFrame) -> str:
    """The profile as a Markdown table, control characters escaped."""
    rows = ["| column | rows | nulls | distinct | bytes | least | greatest |", "|-|-|-|-|-|-|-|"]
    for r in profile.orderBy("column").collect():
        cells = [r["column"], r["rows"], r["nulls"], r["distinct"], f"{r['min_len']}-{r['max_len']}", r["min_value"], r["max_value"]]
        rows.append("| " + " | ".join(re.sub(r"[\x00-\x1f\x7f]", lambda m: f"\\x{ord(m[0]):02x}", str(c)).replace("|", "\\|") for c in cells) + " |")
    return "\n".join(rows) + "\n"


def quarantine_ddl(contract: TableContract, database: str = "quarantine") -> str:
    """A table of text columns only, without defaults, to look at rows in that broke the contract."""
    from tessera.operators.schema import flattened

    nullable = {c.name for c in contract.kept if c.nullable}
    lines = [f"  `{n}` {'Nullable(String)' if n in nullable else 'String'}" for n in flattened(contract)]
    return f"CREATE TABLE `{database}`.`{contract.table}` (\n" + ",\n".join(lines) + "\n) ENGINE = MergeTree ORDER BY tuple()"


def staging_name(table: str, batch: str) -> str:
    """A name for a batch's staging table that far systems accept."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]{1,200}", table):
        raise UsageError(f"{table!r} is not a usable name")
    return f"{table}__{hashlib.sha256(batch.encode()).hexdigest()[:12]}"


def insert_test(df: DataFrame, scratch: str) -> int:
    """Write to a scratch path, read back, compare counts; the rows read."""
    df.write.mode("errorifexists").parquet(scratch)
    wrote, read = df.count(), df.sparkSession.read.schema(df.schema).parquet(scratch).count()
    if wrote != read:
        raise FindingError(f"inserted {wrote} rows, read {read}")
    return read
