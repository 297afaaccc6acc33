"""The registered queries of the audit engine and the SQL that must give the same rows."""

from __future__ import annotations

import datetime
import re
import tempfile
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.contracts import ColumnContract, TableContract
from tessera.errors import UsageError
from tessera.functions import export
from tessera.functions import validators as v
from tessera.functions.catalogue import SECRETS, patterns
from tessera.functions.payloads import decoded_scan, nfc_differs, sample_hex
from tessera.operators import findings, paging, profile, reconcile, schema
from tessera.plans import publish
from tessera.session import make_importable
from tessera.sources import discovery

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            make_importable(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pattern(p: str) -> str:
    return "'(?m)" + p.replace("'", "''") + "'"


def _class_sql(name: str, column: str, classes: dict[str, str]) -> str:
    tests = [f"select '{c}' as class, cast(count(*) as bigint) as rows from {name} where regexp_matches({column}, {_pattern(p)})" for c, p in classes.items()]
    return "select * from (" + " union all ".join(tests) + ") where rows > 0"


# --- payload classes in raw text -------------------------------------------------------------------------------------

_TEXT = {"documents": ("text", "doc_id"), "pages": ("html", "page_id"), "conversations": ("text", "conv_id"), "events": ("props", "event_id")}


def _classes(spark: SparkSession, sf_dir: str, name: str, column: str, key: str, only: Collection[str] | None = None) -> DataFrame:
    found = findings.payload_findings(table(spark, sf_dir, name), [column], F.col(key), only)
    return found.groupBy("class").agg(F.count("*").alias("rows"))


def _register_payloads() -> None:
    for query, name, column, key in (
        ("payload_raw_documents", "documents", "text", "doc_id"),
        ("payload_raw_pages_html", "pages", "html", "page_id"),
        ("payload_raw_pages_url", "pages", "url", "page_id"),
        ("payload_raw_conversations", "conversations", "text", "conv_id"),
        ("payload_raw_event_props", "events", "props", "event_id"),
    ):
        register(query, _class_sql(name, column, patterns()))(lambda s, d, name=name, column=column, key=key: _classes(s, d, name, column, key))


_register_payloads()


@register("secrets_raw_documents", _class_sql("documents", "text", {k: p for k, p in patterns().items() if k in SECRETS}))
def secrets_raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classes(spark, sf_dir, "documents", "text", "doc_id", SECRETS)


@register("payload_inventory", " union all ".join(f"select '{t}' as source, '{c}' as column_name, class, rows from ({_class_sql(t, c, patterns())})" for t, (c, _) in _TEXT.items()))
def payload_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [_classes(spark, sf_dir, t, c, k).select(F.lit(t).alias("source"), F.lit(c).alias("column_name"), "class", "rows") for t, (c, k) in _TEXT.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("payload_decoded_documents")
def payload_decoded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", decoded_scan(F.col("text")).alias("s")).select("doc_id", "s.*").filter((F.size("classes") > 0) | F.col("normalises_differently") | F.col("over_budget"))


@register("normalise_differs", "select doc_id, nfc_normalize(text) <> text as differs from documents where text is not null")
def normalise_differs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", nfc_differs(F.col("text")).alias("differs"))


@register("hex_samples", "select doc_id, substr(lower(hex(encode(text))), 1, 128) as sample_hex from documents")
def hex_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", sample_hex(F.col("text")).alias("sample_hex"))


# --- validators ------------------------------------------------------------------------------------------------------


def _reasons(df: DataFrame, reason) -> DataFrame:
    return df.select(reason.alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


@register("control_bytes", "select page_id from pages where regexp_matches(html, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]')")
def control_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").filter(v.free_text(F.col("html")).isNotNull() & F.col("html").isNotNull()).select("page_id")


@register("length_caps", "select doc_id, cast(strlen(text) as bigint) as n_bytes from documents where strlen(text) > 4096")
def length_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, rule = table(spark, sf_dir, "documents"), ColumnContract("text", "Nullable(String)", max_len=4096, freedom="open")
    over = v.column_reason(F.col("text"), rule, text=False) == "too long"
    return docs.filter(over).select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"))


@register("anchored_pattern_mktsegment", "select c_custkey, 'breaks the pattern' as reason from customer where not regexp_full_match(c_mktsegment, '(AUTOMOBILE|BUILDING|MACHINERY)')")
def anchored_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = ColumnContract("c_mktsegment", "String", pattern="^(AUTOMOBILE|BUILDING|MACHINERY)$")
    return table(spark, sf_dir, "customer").select("c_custkey", v.column_reason(F.col("c_mktsegment"), rule).alias("reason")).filter("reason is not null")


@register("enum_membership_orderstatus", "select o_orderstatus, cast(count(*) as bigint) as rows from orders where o_orderstatus not in ('F', 'O') group by 1")
def enum_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = ColumnContract("o_orderstatus", "String", allowed=("F", "O"))
    bad = table(spark, sf_dir, "orders").filter(v.column_reason(F.col("o_orderstatus"), rule).isNotNull())
    return bad.groupBy("o_orderstatus").agg(F.count("*").alias("rows"))


@register("int_range_partkey", "select case when p_partkey > 255 then 'integer out of range' end as reason, cast(count(*) as bigint) as rows from part group by 1")
def int_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(table(spark, sf_dir, "part"), v.integer_in_range(F.col("p_partkey").cast("string"), 0, 255))


@register(
    "decimal_shape_acctbal",
    "select case when abs(cast(c_acctbal as decimal(12, 2))) >= 1000 then 'decimal too large' end as reason, cast(count(*) as bigint) as rows from customer group by 1",
)
def decimal_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(table(spark, sf_dir, "customer"), v.decimal_shape(F.col("c_acctbal").cast("decimal(12,2)").cast("string"), 5, 2))


@register(
    "date_range_shipdate",
    "select case when cast(l_shipdate as date) not between date '1993-01-01' and date '1996-12-31' then 'date out of range' end as reason, cast(count(*) as bigint) as rows from lineitem group by 1",
)
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(table(spark, sf_dir, "lineitem"), v.calendar_date(F.date_format("l_shipdate", "yyyy-MM-dd"), "1993-01-01", "1996-12-31"))


_NIBBLE = " + ".join(f"{8 >> k} * cast(substr(b, 4 * i + {k + 1}, 1) as int)" for k in range(4))


@register(
    "float_bits_discount",
    f"select l_orderkey, l_linenumber, l_discount, array_to_string(list_transform(range(0, 16), lambda i: substr('0123456789abcdef', 1 + {_NIBBLE}, 1)), '') as bits from (select *, cast(cast(l_discount as bit) as varchar) as b from lineitem)",
)
def float_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", export.float_bits(F.col("l_discount")).alias("bits"))


@register("null_violations", "select doc_id, 'null in a column without nulls' as reason from documents where text is null")
def null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = ColumnContract("text", "String", freedom="open")
    return table(spark, sf_dir, "documents").filter(F.col("text").isNull()).select("doc_id", v.column_reason(F.col("text"), rule).alias("reason"))


@register("array_caps_embeddings", "select vec_id, cast(len(embedding) as int) as n from embeddings where len(embedding) > 32")
def array_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").filter(v.nested_reason(F.col("embedding"), max_elements=32).isNotNull()).select("vec_id", F.size("embedding").alias("n"))


@register(
    "nested_leaf_audit",
    "select conv_id, cast(sum(strlen(text)) as bigint) as n_bytes, cast(count(*) as int) as n from conversations group by 1 having sum(strlen(text)) > 2000 or count(*) > 4",
)
def nested_leaf_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list("text").alias("texts"), F.sum(F.octet_length("text")).alias("n_bytes"), F.count("*").cast("int").alias("n"))
    whole = v.nested_reason(F.col("texts"), max_elements=4, max_bytes=2000)
    return talks.filter(whole.isNotNull() | (F.col("n") > 4)).select("conv_id", "n_bytes", "n")


_CUSTOMER = TableContract(
    "customer",
    (
        ColumnContract("c_custkey", "Int64"),
        ColumnContract("c_name", "String", max_len=18, freedom="open"),
        ColumnContract("c_nationkey", "Int32"),
        ColumnContract("c_mktsegment", "String", allowed=("AUTOMOBILE", "BUILDING", "FURNITURE")),
    ),
    order_by=("c_custkey",),
)
_AUDIT_SQL = """
select 'c_mktsegment' as col, 'not an allowed value' as reason, c_custkey as row, c_mktsegment as value from customer where c_mktsegment not in ('AUTOMOBILE', 'BUILDING', 'FURNITURE')
union all select 'c_name', 'too long', c_custkey, c_name from customer where strlen(c_name) > 18
"""


def _customer_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings.audit(table(spark, sf_dir, "customer"), list(_CUSTOMER.columns), F.col("c_custkey"), text=False)


@register("audit_findings", f"""select 'contract' as phase, col as "column", 0 as file, row, reason, col <> 'c_name' as escalate, substr(lower(hex(encode(value))), 1, 128) as sample_hex from ({_AUDIT_SQL})""")
def audit_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_findings(spark, sf_dir).select("phase", "column", "file", "row", "reason", "escalate", "sample_hex")


@register("findings_by_reason", f'select col as "column", reason, cast(count(*) as bigint) as findings, cast(count(distinct row) as bigint) as rows from ({_AUDIT_SQL}) group by 1, 2')
def findings_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings.by_reason(_customer_findings(spark, sf_dir))


@register(
    "findings_inventory",
    f"""select col as "column", cast(count(distinct row) as bigint) as rows, string_agg(distinct reason, ';') as reasons,
    array_to_string(list(lower(hex(encode(value))) order by row)[1:5], ',') as samples from ({_AUDIT_SQL}) group by 1""",
)
def findings_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings.inventory(_customer_findings(spark, sf_dir)).select("column", "rows", F.array_join("reasons", ";").alias("reasons"), F.array_join("samples", ",").alias("samples"))


# --- profiles --------------------------------------------------------------------------------------------------------

_PROFILED = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
_CELLS = " union all ".join(f"select '{c}' as col, cast({c} as varchar) as v from customer" for c in _PROFILED)


@register(
    "profile_customer",
    f"""select col as "column", cast(count(*) as bigint) as rows, cast(count(*) - count(v) as bigint) as nulls, cast(count(distinct v) as bigint) as "distinct",
    cast(coalesce(min(strlen(v)), 0) as int) as min_len, cast(coalesce(max(strlen(v)), 0) as int) as max_len, min(v) as min_value, max(v) as max_value,
    (count(*) - count(v)) / count(*) as null_rate, count(distinct v) <= 1 and count(*) > 1 as constant from ({_CELLS}) group by 1""",
)
def profile_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.exact_profile(table(spark, sf_dir, "customer"), list(_PROFILED))


_TOP = ("l_returnflag", "l_linestatus", "l_linenumber")


@register(
    "profile_lineitem_top5",
    'select col as "column", cast(r as int) as rank, v as value, cast(n as bigint) as n from (select col, v, count(*) as n, row_number() over (partition by col order by count(*) desc, v) as r from ('
    + " union all ".join(f"select '{c}' as col, cast({c} as varchar) as v from lineitem" for c in _TOP)
    + ") where v is not null group by 1, 2) where r <= 5",
)
def profile_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_values(table(spark, sf_dir, "lineitem"), list(_TOP)).select("column", "rank", "value", "n")


@register(
    "profile_duplicates",
    "select cast(sum(n) as bigint) as rows, cast(count(*) as bigint) as distinct_rows, cast(sum(n - 1) as bigint) as duplicate_rows from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)",
)
def profile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("constant_columns", "select 'one' as \"column\", cast(1 as bigint) as \"distinct\", true as constant union all select 'r_name', count(distinct r_name), count(distinct r_name) <= 1 from region")
def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.exact_profile(table(spark, sf_dir, "region").withColumn("one", F.lit(1)), ["one", "r_name"]).select("column", "distinct", "constant")


@register("kmv_distinct")
def kmv_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.kmv_distinct(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"])


@register("frequent_values")
def frequent_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.frequent_values(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey"])


@register("content_sha256", "select doc_id, sha256(text) as sha from documents")
def content_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


# --- order and pages -------------------------------------------------------------------------------------------------

_LINE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@register("keyset_page", f"select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem where (l_orderkey, l_linenumber) > (100, 2) order by {_LINE_ORDER} limit 500")
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], 500, [100, 2]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@register("total_order_topk", f"select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem order by {_LINE_ORDER} limit 100")
def total_order_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], 100).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@register("page_assignment", "select event_id, cast((row_number() over (order by event_id) - 1) // 1000 as bigint) as page from events")
def page_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.assign_pages(table(spark, sf_dir, "events").select("event_id"), ["event_id"], 1000)


_GROUPED = "select l_orderkey, count(*) as n, cast((sum(count(*)) over (order by l_orderkey rows between unbounded preceding and current row) - count(*)) as bigint) // 500 as page from lineitem group by 1"


@register("key_group_extension", f"select page, cast(sum(n) as bigint) as rows, max(l_orderkey) as last_key, cast(max_by(n, l_orderkey) as bigint) as tail from ({_GROUPED}) group by 1")
def key_group_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    paged = paging.assign_pages(table(spark, sf_dir, "lineitem").select("l_orderkey"), ["l_orderkey"], 500)
    return paging.page_summary(paged, ["l_orderkey"]).select("page", "rows", F.col("last.l_orderkey").alias("last_key"), "tail")


@register("repeated_keys", "select l_orderkey, cast(count(*) as bigint) as n from lineitem group by 1 having count(*) > 1")
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.adjacent_duplicates(table(spark, sf_dir, "lineitem"), "l_orderkey")


@register("row_numbers", "select o_orderkey, cast(row_number() over () as bigint) as row from orders")
def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.numbered(table(spark, sf_dir, "orders").select("o_orderkey", "_metadata")).select("o_orderkey", "row")


# --- reconciliation --------------------------------------------------------------------------------------------------


@register(
    "two_pass_diff",
    "select o_orderkey, read, cast(n as bigint) as n from (select o_orderkey, 'first' as read, 1 as n from orders where o_orderkey % 7 = 0 union all select o_orderkey + 1000000000, 'second', 1 from orders where o_orderkey % 11 = 0)",
)
def two_pass_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "orders").select("o_orderkey")
    second = first.filter("o_orderkey % 7 != 0").unionByName(first.filter("o_orderkey % 11 = 0").select((F.col("o_orderkey") + 1000000000).alias("o_orderkey")))
    return reconcile.difference(first, second)


@register("reconcile_counts", "select cast(count(*) as bigint) as streamed, cast(count(*) as bigint) as counted, true as agree from orders")
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of one read against the row count of another."""
    streamed = profile.content_checksum(table(spark, sf_dir, "orders")).select(F.col("rows").alias("streamed"))
    counted = table(spark, sf_dir, "orders").agg(F.count("*").alias("counted"))
    return streamed.crossJoin(F.broadcast(counted)).withColumn("agree", F.col("streamed") == F.col("counted"))


@register(
    "ledger_join",
    "select o_orderkey, 'o_orderstatus' as field, o_orderstatus as \"left\", 'X' as \"right\" from orders where o_orderkey % 100 = 0 and o_orderkey % 101 <> 0 union all select o_orderkey, f, case when f = 'o_orderstatus' then o_orderstatus else cast(o_custkey as varchar) end, null from orders, (values ('o_orderstatus'), ('o_custkey')) t(f) where o_orderkey % 101 = 0",
)
def ledger_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    ledger = orders.filter("o_orderkey % 101 != 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 100 == 0, "X").otherwise(F.col("o_orderstatus")))
    return reconcile.field_mismatches(orders, ledger, "o_orderkey", ["o_orderstatus", "o_custkey"])


@register("content_checksum")
def content_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.content_checksum(table(spark, sf_dir, "lineitem"))


# --- schemas ---------------------------------------------------------------------------------------------------------


@register(
    "schema_cross_check",
    "select * from (values (1, 'body', 'string', 'text', 'string'), (5, 'extra', 'int', null, null)) t(position, pinned_name, pinned_type, observed_name, observed_type)",
)
def schema_cross_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    pinned = T.StructType().add("doc_id", "long").add("body", "string").add("lang", "string").add("source", "string").add("n_chars", "long").add("extra", "integer")
    observed = table(spark, sf_dir, "documents").schema
    return schema.cross_check(schema.relation(spark, pinned), schema.relation(spark, observed))


@register("schema_drift", "select * from (values ('doc_id', 'same'), ('text', 'retyped'), ('lang', 'same'), ('source', 'extra'), ('n_chars', 'tightened'), ('venue', 'padded')) t(name, outcome)")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = T.StructType().add("doc_id", "long").add("text", "binary").add("lang", "string").add("n_chars", "long", False).add("venue", "string")
    return schema.drift(schema.relation(spark, table(spark, sf_dir, "documents").schema), schema.relation(spark, target))


@register("schema_projection", "select lang, doc_id from documents")
def schema_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = T.StructType().add("lang", "string").add("doc_id", "long")
    return schema.project(table(spark, sf_dir, "documents"), target, drop={"text", "source", "n_chars"})[0]


@register("null_padding", "select doc_id, cast(null as varchar) as venue, n_chars from documents")
def null_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = T.StructType().add("doc_id", "long").add("venue", "string").add("n_chars", "long")
    return schema.project(table(spark, sf_dir, "documents"), target, drop={"text", "source", "lang"})[0]


# --- partitions ------------------------------------------------------------------------------------------------------


@register("partition_exclusion", "select distinct cast(ts as date) as date from events where cast(ts as date) <> (select min(cast(ts as date)) from events)")
def partition_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("date")).distinct()
    return discovery.exclude(days, days.agg(F.min("date").alias("date")), ["date"])


@register("partition_rollup", 'select event_type as "table", cast(cast(ts as date) as varchar) as state, cast(count(*) as bigint) as partitions, cast(sum(event_id) as bigint) as rows from events group by rollup (event_type, cast(cast(ts as date) as varchar))')
def partition_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("table"), F.date_format("ts", "yyyy-MM-dd").alias("state"), F.col("event_id").alias("rows"))
    return publish.rollup(events)


@register("date_sequence", "select cast(d as date) as date from generate_series(timestamp '2024-02-01', timestamp '2024-03-31', interval 1 day) t(d)")
def date_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.dates(spark, datetime.date(2024, 2, 1), datetime.date(2024, 3, 31))


@register("file_numbers", "select cast(ts as date) as date, event_id as path, cast(dense_rank() over (partition by cast(ts as date) order by event_id) - 1 as int) as file from events")
def file_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.file_numbers(table(spark, sf_dir, "events").select(F.to_date("ts").alias("date"), F.col("event_id").alias("path")))


# --- export ----------------------------------------------------------------------------------------------------------


@register("map_pairs_sorted", "select c_custkey, '[' || '\"a\",\"z\"' || ']' as keys, '[\"' || cast(c_nationkey as varchar) || '\",\"' || c_mktsegment || '\"]' as vals from customer")
def map_pairs_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.create_map(F.lit("z"), F.col("c_mktsegment"), F.lit("a"), F.col("c_nationkey").cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.to_json(export.map_keys_sorted(pairs)).alias("keys"), export.json_array_text(export.map_values_sorted(pairs)).alias("vals"))


def _tsv_sql(column: str) -> str:
    out = f"replace(cast({column} as varchar), '\\', '\\\\')"
    for raw, written in export.ESCAPES[1:]:
        if raw != "\0":
            out = f"replace({out}, {'chr(' + str(ord(raw)) + ')'}, '{written.replace(chr(39), chr(39) * 2)}')"
    return f"coalesce({out}, '\\N')"


@register("tsv_encode", f"select doc_id, {_tsv_sql('doc_id')} || chr(9) || {_tsv_sql('text')} || chr(9) || {_tsv_sql('lang')} as line from documents")
def tsv_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", export.tsv_row(F.col("doc_id"), F.col("text"), F.col("lang")).alias("line"))


@register("utc_text", "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') as t, cast(epoch_us(ts) // 1000000 as bigint) as s from events")
def utc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", export.utc_text(F.col("ts"), 3).alias("t"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"))


@register("provenance_columns", f"select r_regionkey, r_name, 'region.parquet' as _source, 'abc' as _source_sha256, '{TableContract('region', (ColumnContract('r_regionkey', 'Int32'), ColumnContract('r_name', 'String'))).digest}' as _contract from region")
def provenance_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = TableContract("region", (ColumnContract("r_regionkey", "Int32"), ColumnContract("r_name", "String")))
    return publish.with_provenance(table(spark, sf_dir, "region"), "region.parquet", "abc", contract)


def _scratch(spark: SparkSession) -> str:
    """A new folder that all executors share, gone when the JVM ends; on one machine without such a setting a local one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise UsageError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
    out = f"{base.rstrip('/')}/{spark.sparkContext.applicationId}-{spark._jvm.java.util.UUID.randomUUID()}"
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return out


@register("regenerate_roundtrip", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def regenerate_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _scratch(spark)
    publish.regenerate(table(spark, sf_dir, "customer"), out, rows_per_file=400)
    return spark.read.parquet(out)


_PUBLISHED = TableContract("lineitem", tuple(ColumnContract(n, t) for n, t in (("l_orderkey", "Int64"), ("l_partkey", "Int64"), ("l_suppkey", "Int64"), ("l_linenumber", "Int32"), ("l_quantity", "Float64"), ("l_extendedprice", "Float64"), ("l_discount", "Float64"), ("l_tax", "Float64"), ("l_returnflag", "String"), ("l_linestatus", "String"), ("l_shipdate", "DateTime64(6)"))))


@register("publish_manifest", "select 'lineitem' as \"table\", cast(count(*) as bigint) as rows, 'complete' as state from lineitem")
def publish_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = publish.publish(table(spark, sf_dir, "lineitem"), _PUBLISHED, f"{sf_dir}/lineitem.parquet", _scratch(spark), key=F.col("l_orderkey"), signed_off=True)
    return spark.createDataFrame([(done["table"], done["rows"], done["state"])], "table string, rows long, state string")
