"""Findings, profiles, pages, schemas, reading and publishing, each against a plain version or planted damage."""

import datetime
import gzip
import io
import json
import os
import random
import tarfile
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.contracts import ColumnContract, Limits, TableContract, check_policy_columns
from tessera.errors import FindingError, InfraError, UsageError, gravest
from tessera.functions import export
from tessera.operators import findings, paging, profile, reconcile, schema
from tessera.plans import publish
from tessera.sources import archive, discovery, footers, tsv
from tessera.streaming import days


def test_audit_one_finding_per_value(spark):
    rows = [(1, "fine", 5), (2, "a; drop", None), (3, "x\x00; y", 7), (4, None, 1)]
    df = spark.createDataFrame(rows, "id long, body string, n int")
    columns = [ColumnContract("body", "String", freedom="open"), ColumnContract("n", "Int32")]
    got = {(r.row, r.column): r for r in findings.audit(df, columns, F.col("id"), text=False).collect()}
    assert set(got) == {(2, "body"), (2, "n"), (3, "body"), (4, "body")}
    assert got[2, "body"].classes == ["sql", "shell"] and not got[2, "body"].escalate and got[2, "body"].sample_hex == b"a; drop".hex()
    assert got[3, "body"].reason == "control character" and not got[4, "body"].escalate and got[2, "n"].escalate
    hits = findings.audit(df, columns, F.col("id"), text=False)
    assert {r.column: r.rows for r in findings.inventory(hits).collect()} == {"body": 3, "n": 1}
    assert findings.capped_samples(hits, 20).count() < hits.count()
    with pytest.raises(FindingError, match="body, file 0, row 2"):
        findings.enforce(hits)


def test_audit_decodes_walks_and_knows_the_incident(spark):
    rows = [
        (1, "fine", ["a", "b"], {"k": "v"}, (1, "x")),
        (2, "%3Cscript%3E", ["a"], {}, (1, "x")),
        (3, "PHNjcmlwdD4=", None, None, None),
        (4, "the canary sings", ["a"], {"k": "<script"}, (1, "x")),
        (5, "x" * 70, ["a", "b", "c", "d"], {"k": "a\x00b"}, (2, "$(id)")),
        (6, None, ["ok", "<iframe src"], {"k": None}, (3, None)),
    ]
    df = spark.createDataFrame(rows, "id long, body string, tags array<string>, labels map<string,string>, pair struct<n:int,t:string>").withColumn("decoded_0", F.lit("x"))
    columns = [ColumnContract("body", "Nullable(String)"), ColumnContract("tags", "Array(String)"), ColumnContract("labels", "Map(String, String)"), ColumnContract("pair", "Tuple(n Int32, t String)")]
    hits = findings.audit(df, columns, F.col("id"), text=False, limits=Limits(max_field_bytes=64, max_elements=3), iocs=("canary",)).collect()
    got = {(r.row, r.column): (r.reason, r.via) for r in hits}
    assert got[2, "body"] == ("payload: html_js", ["percent"]) and got[3, "body"] == ("payload: html_js", ["base64"])
    assert got[4, "body"] == ("payload: ioc_canary", ["raw"]) and got[4, "labels"] == ("payload: html_js", ["raw"])
    assert got[5, "body"][0] == "too long" and got[5, "tags"][0] == "too many elements" and got[5, "labels"][0] == "control character" and got[5, "pair"][0].startswith("payload: shell")
    assert got[6, "tags"][0] == "payload: html_js" and not any(k == 1 for k, _ in got) and (6, "body") not in got and (6, "pair") not in got


def test_values_with_nothing_to_decode_never_go_to_python(spark, monkeypatch):
    columns = [ColumnContract("flag", "Nullable(String)"), ColumnContract("n", "Int32")]
    df = spark.createDataFrame([("A", 1), (".", 2), ("", 3), (None, 4)], "flag string, n int").repartition(2)
    rows = df.unionByName(spark.createDataFrame([(";", 5), ("Jw", 6), ("\u00e9", None)], df.schema)).coalesce(1)
    hits = findings.audit(rows, columns, F.monotonically_increasing_id(), text=False, limits=Limits())
    # The key counts all rows, those too that are set aside.
    assert {(r.column, r.row, r.reason) for r in hits.collect()} == {("flag", 4, "payload: sql,shell"), ("flag", 5, "payload: sql"), ("n", 6, "null in a column without nulls")}
    monkeypatch.setattr(findings, "decoded_scan", lambda value, **_: F.raise_error(F.lit("sent to Python")).cast("struct<classes: array<string>, via: array<string>, over_budget: boolean>"))
    assert findings.audit(df, columns, F.col("n"), text=False, limits=Limits()).count() == 0


def test_an_encoded_payload_is_not_published(spark, tmp_path):
    contract = TableContract("t", (ColumnContract("id", "Int64"), ColumnContract("body", "String")))
    df = spark.createDataFrame([(1, "%3Cscript%3E")], "id long, body string")
    with pytest.raises(FindingError, match="html_js"):
        publish.publish(df, contract, "/raw", f"{tmp_path}/out", key=F.col("id"), signed_off=True)
    assert not (tmp_path / "out").exists()


def test_profiles(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "bb", None, "é"]), rng.randrange(1000), "same") for _ in range(4000)]
    df = spark.createDataFrame(rows, "a string, b int, c string")
    got = {r.column: r for r in profile.exact_profile(df, ["a", "b", "c"]).collect()}
    assert got["a"].distinct == 3 and got["a"].nulls == sum(r[0] is None for r in rows) and (got["a"].min_len, got["a"].max_len) == (1, 2)
    assert got["c"].constant and not got["b"].constant and got["b"].min_value == "0"
    assert profile.exact_profile(df.limit(0), ["a"]).count() == 0
    top = [(r.value, r.n) for r in profile.top_values(df, ["a"], 2).orderBy("rank").collect()]
    assert top == sorted(Counter(r[0] for r in rows if r[0]).items(), key=lambda x: (-x[1], x[0]))[:2]
    kmv = {r.column: r.distinct_estimate for r in profile.kmv_distinct(df, ["a", "b"]).collect()}
    true = len({r[1] for r in rows})
    assert kmv["a"] == 3 and abs(kmv["b"] - true) < 0.25 * true
    heavy = spark.createDataFrame([("hot" if i % 3 == 0 else f"v{i}",) for i in range(3000)], "x string").repartition(5)
    found = {r.value: r for r in profile.frequent_values(heavy, ["x"]).collect()}
    assert found["hot"]["count"] - found["hot"].overcount <= 1000 <= found["hot"]["count"]


def test_merged_sketches_lose_no_frequent_value(spark):
    # Evicted in the first task, which sees it first; counted in the second; more than rows / counters in all.
    tasks = [["lost"] * 90 + [f"a{i % 16}" for i in range(1510)], [f"b{i % 40}" for i in range(1489)] + ["lost"] * 111]
    df = spark.createDataFrame([(t, i, x) for t, task in enumerate(tasks) for i, x in enumerate(task)], "t int, i int, x string").repartitionByRange(2, "t").sortWithinPartitions("t", "i").select("x")
    true = Counter(x for task in tasks for x in task)
    found = {r.value: r for r in profile.frequent_values(df, ["x"]).collect()}
    assert true["lost"] == 201 and "lost" in found and len(found) == 16
    assert all(r["count"] - r.overcount <= true[v] <= r["count"] for v, r in found.items())


def test_float_bits_and_checksums(spark):
    import struct as packing

    df = spark.createDataFrame([(0.1,), (-0.0,), (float("inf"),), (None,)], "x double")
    got = [r.b for r in df.select(export.float_bits(F.col("x")).alias("b")).collect()]
    assert got == [None if x is None else packing.pack(">d", x).hex() for x in (0.1, -0.0, float("inf"), None)]
    table = spark.range(500).withColumn("s", F.col("id").cast("string"))
    a, b = profile.content_checksum(table).first(), profile.content_checksum(table.orderBy(F.desc("id")).repartition(7)).first()
    assert a == b and a.rows == 500 and profile.content_checksum(table.filter("id < 499")).first().xor != a.xor


def test_pages_keep_key_groups_whole(spark):
    rng = random.Random(4)
    keys = sorted(rng.choice([1, 2, 3, 50, 51, 52, 53, 99]) for _ in range(300))
    paged = paging.assign_pages(spark.createDataFrame([(k,) for k in keys], "k int"), ["k"], 40)
    starts = {k: keys.index(k) // 40 for k in set(keys)}
    assert {(r.k, r.page) for r in paged.distinct().collect()} == set(starts.items()) and paged.count() == 300
    with pytest.raises(FindingError):
        paging.assign_pages(paged.select("k"), ["k"], 40, widest=5)
    rows = [(1, None), (1, 2), (2, 1), (2, 1), (3, 0)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert [tuple(r) for r in paging.page(df, ["a"], 2).collect()] == [(1, 2), (1, None)]
    assert [tuple(r) for r in paging.page(df, ["a", "b"], 9, [2, 0]).collect()] == [(2, 1), (2, 1), (3, 0)]
    assert df.filter(paging.in_group(["a", "b"], [2, 1])).count() == 2
    assert paging.rows_per_page(1000, 10, 550) == 5 and paging.rows_per_page(0, 0, 0) == 1


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "i int, s string")
    assert sorted((r.i, r.read, r.n) for r in reconcile.difference(a, b).collect()) == [(1, "first", 1), (3, "second", 1)]
    assert reconcile.difference(a, a).count() == 0
    reconcile.reconcile_counts(3, 3, 5)
    for wrong in ((3, 4, 5), (6, 6, 5)):
        with pytest.raises(FindingError):
            reconcile.reconcile_counts(*wrong)
    with pytest.raises(FindingError):
        reconcile.same_inventory(a, b, ["i"])
    assert isinstance(gravest([InfraError("i"), FindingError("f")]), FindingError)


def test_schemas(spark):
    body = T.StructType().add("body", "string", False)
    wide = T.StructType().add("body", "string", False).add("venue", "string")
    df = spark.createDataFrame([("x",)], body)
    out, padded = schema.project(df, wide)
    assert padded == ["venue"] and [tuple(r) for r in out.collect()] == [("x", None)]
    for call in (lambda: schema.project(df, wide, reviewed={"venue"}), lambda: schema.project(df.withColumn("q", F.lit(1)), wide), lambda: schema.project(df, T.StructType().add("body", "integer")), lambda: schema.agreed([body, wide])):
        with pytest.raises(FindingError):
            call()
    assert schema.agreed([body, body]) == body and schema.schema_hash(body) != schema.schema_hash(wide)
    contract = schema.infer_contract("t", T.StructType().add("a", T.ArrayType(T.IntegerType())).add("m", T.MapType(T.StringType(), T.LongType())).add("t", "timestamp", False).add("d", T.DecimalType(5, 2)))
    assert [c.type for c in contract.columns] == ["Array(Nullable(Int32))", "Map(String, Int64)", "DateTime64(6)", "Nullable(Decimal(5, 2))"]
    assert schema.flattened(contract) == ["a", "m.keys", "m.values", "t", "d"]
    assert schema.target_schema(TableContract("t", (ColumnContract("body", "String"), ColumnContract("venue", "String"))), [body, wide]) == T.StructType().add("body", "string", False).add("venue", "string")
    assert "Nullable(String)" in publish.quarantine_ddl(contract) and publish.staging_name("t", "b") == publish.staging_name("t", "b")
    with pytest.raises(UsageError):
        check_policy_columns(["gone"], ["here"])


def test_tsv_round_trip_and_damage(spark, tmp_path):
    values = [("a\tb\nc", "q'\\"), (None, ""), ("\\N", "\x08\x0c\r"), ("é", "x\\ty")]
    df = spark.createDataFrame(values, "p string, q string")
    lines = [r.l for r in df.select(export.tsv_row(F.col("p"), F.col("q")).alias("l")).collect()]
    (tmp_path / "good").mkdir()
    (tmp_path / "good/a.tsv").write_text("p\tq\n" + "\n".join(lines) + "\n")
    rows, bad = tsv.read_pages(spark, f"file://{tmp_path}/good", ["p", "q"])
    assert sorted(map(str, ((r.p, r.q) for r in rows.collect()))) == sorted(map(str, values)) and bad.count() == 0
    (tmp_path / "good/a.tsv").write_text("p\tq\na\\xb\tc\nonly\n" + "y" * 50 + "\tz\nok\tok\n")
    rows, bad = tsv.read_pages(spark, f"file://{tmp_path}/good", ["p", "q"], max_field_bytes=40)
    assert [r.p for r in rows.collect()] == ["ok"] and Counter(r.reason for r in bad.collect()) == {"illegal escape or raw control byte": 1, "wrong width": 1, "field too long": 1}
    with pytest.raises(FindingError):
        tsv.read_pages(spark, f"file://{tmp_path}/good", ["p", "other"])


def tar(*members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=tarfile.USTAR_FORMAT) as t:
        for info, data in members:
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def info(name, size=1, kind=tarfile.REGTYPE):
    x = tarfile.TarInfo(name)
    x.size, x.type = size, kind
    return x


def test_archives(spark, tmp_path):
    files = {"b.json": b"{}", "a.tsv": b"p\n1\n"}
    packed = archive.pack(files)
    assert packed == archive.pack(dict(reversed(files.items()))) and archive.members(archive.gunzip_one(packed)) == files
    hostile = {
        "link": tar((info("x", 0, tarfile.SYMTYPE), b"")),
        "hard": tar((info("x", 0, tarfile.LNKTYPE), b"")),
        "climb": tar((info("../x"), b"y")),
        "root": tar((info("/x"), b"y")),
        "twice": tar((info("x"), b"y"), (info("x"), b"z")),
        "cut": tar((info("x", 600), b"y" * 600))[:700],
        "tail": tar((info("x"), b"y")) + b"more",
    }
    for name, data in hostile.items():
        with pytest.raises(FindingError):
            pytest.fail(name) if archive.members(data) else None
    for data in (packed + b"x", packed[:-4], packed + gzip.compress(b"x"), b"no gzip", gzip.compress(b"\0" * (1 << 22))):
        with pytest.raises(FindingError):
            archive.gunzip_one(data)
    (tmp_path / "ok.tar.gz").write_bytes(packed)
    (tmp_path / "bad.tar.gz").write_bytes(packed + b"x")
    rows = archive.read_archives(spark, f"file://{tmp_path}").collect()
    assert Counter(r.error is None for r in rows) == {True: 2, False: 1}


def test_footers(spark, tmp_path):
    pq.write_table(pa.table({"x": list(range(100))}), tmp_path / "a.parquet", row_group_size=30)
    whole = (tmp_path / "a.parquet").read_bytes()
    (tmp_path / "b.parquet").write_bytes(whole[:-1])
    start = len(whole) - 8 - int.from_bytes(whole[-8:-4], "little")
    (tmp_path / "c.parquet").write_bytes(whole[:start] + b"\xff" * 20 + whole[start + 20 :])
    facts = footers.footer_facts(spark, f"file://{tmp_path}")
    by = {os.path.basename(r.path): r for r in facts.collect()}
    assert (by["a.parquet"].rows, by["a.parquet"].group_rows, by["a.parquet"].row_groups) == (100, 100, 4)
    assert {os.path.basename(r.path) for r in footers.guard(facts).collect()} == {"b.parquet", "c.parquet"}
    assert footers.guard(facts.filter("error is null"), max_footer=10).count() == 1
    wide = spark.createDataFrame([(1,), (300,), (-1,)], "x int")
    assert [tuple(r) for r in footers.narrow_integers(wide, {"x": (0, 255)}).collect()] == [("x", 2, -1, 300)]


def test_discovery(spark):
    files = spark.createDataFrame([("file:/r/t/2024/01/02/b.parquet",), ("file:/r/t/2024/01/02/a.parquet",), ("file:/r/u/2024/01/03/a.parquet",)], "path string")
    got = sorted((r.table, str(r.date), r.path[-9:], r.file) for r in discovery.discover(files, "file:/r").collect())
    assert got == [("t", "2024-01-02", "a.parquet", 0), ("t", "2024-01-02", "b.parquet", 1), ("u", "2024-01-03", "a.parquet", 0)]
    for path in ("file:/r/t/2024/1/02/a.parquet", "file:/r/t/2024/02/30/a.parquet", "file:/r/t/x.parquet"):
        with pytest.raises(FindingError):
            discovery.discover(files.unionByName(spark.createDataFrame([(path,)], "path string")), "file:/r")
    parts = spark.createDataFrame([("t", 1), ("t", 2)], "table string, day int")
    assert discovery.exclude(parts, parts.filter("day = 1"), ["table", "day"]).count() == 1
    with pytest.raises(UsageError):
        discovery.exclude(parts, spark.createDataFrame([("typo", 1)], "table string, day int"), ["table", "day"])
    assert discovery.day_prefix("t", datetime.date(2024, 1, 2)) == "t/2024/01/02" and discovery.day_prefix("t", datetime.date(2024, 1, 2), "date/table") == "2024/01/02/t"


def test_publish(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "yy")], "id int, s string")
    contract = TableContract("t", (ColumnContract("id", "Nullable(Int32)"), ColumnContract("s", "Nullable(String)", max_len=2)))
    out = f"file://{tmp_path}/out"
    assert publish.published(spark, out) is None
    done = publish.publish(df, contract, "raw", out, key=F.col("id"), source="f", sha256="0", signed_off=True)
    assert publish.published(spark, out) == done == json.loads((tmp_path / "out/manifest.json").read_text()) and done["rows"] == 2
    assert spark.read.parquet(f"{out}/data").columns == ["id", "s", "_source", "_source_sha256", "_contract"]
    for wrong in ({"raw": out}, {"signed_off": False}):
        with pytest.raises(UsageError):
            publish.publish(df, contract, **({"raw": "raw", "out": out, "key": F.col("id"), "signed_off": True} | wrong))
    bad = df.unionByName(spark.createDataFrame([(3, "toolong")], df.schema))
    with pytest.raises(FindingError):
        publish.publish(bad, contract, "raw", f"{out}2", key=F.col("id"), signed_off=True)
    assert not (tmp_path / "out2").exists()
    assert publish.publish(bad, contract, "raw", f"{out}2", key=F.col("id"), survey=True)["inventory"][0]["rows"] == 1

    def work(name, part):
        if part == 2:
            raise FindingError("x")

    assert publish.run_partitions([("a", 0), ("b", 1), ("c", 2), ("d", 3)], lambda n, p: p == 0, work) == {"a": "reused", "b": "complete", "c": "failed", "d": "interrupted"}
    assert "| s | 2 |" in publish.shape_review(profile.exact_profile(df, ["s"])) and publish.insert_test(df, f"{out}3") == 2


def test_stream_publishes_each_row_once(spark, tmp_path):
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string").write.parquet(source)
    schema_ = T.StructType().add("id", "integer").add("s", "string")
    check = lambda df: findings.audit(df, [ColumnContract("s", "Nullable(String)", max_len=1)], F.col("id"), text=False)
    for more in ([(3, "c")], []):
        days.publish_once(days.day_stream(spark, source, schema_), out, f"{tmp_path}/check", check).awaitTermination()
        if more:
            spark.createDataFrame(more, schema_).write.mode("append").parquet(source)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]
    spark.createDataFrame([(4, "long")], schema_).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="too long"):
        days.publish_once(days.day_stream(spark, source, schema_), out, f"{tmp_path}/check", check).awaitTermination()
    assert spark.read.parquet(out).count() == 3
