"""Types by accept and refuse, validators by boundary values."""

import pytest
from pyspark.sql import functions as F

from tessera.contracts import ColumnContract, Limits, TableContract, cursor_columns, load_contract
from tessera.errors import UsageError
from tessera.functions import validators as v
from tessera.types import parse_type

TYPES = [
    "UInt8", "Int256", "Decimal(76, 76)", "Float32", "Bool", "String", "FixedString(16)", "Date", "Date32", "DateTime", "DateTime64(3)", "Enum8('a' = 1, 'b\\'c' = -2)",
    "UUID", "IPv4", "IPv6", "Nullable(Int8)", "LowCardinality(Nullable(String))", "Array(Nullable(UInt64))", "Map(String, Array(Int32))", "Tuple(a Int8, b String)", "Tuple(Int8, String)", "Nested(a Int8, b Array(String))",
]


@pytest.mark.parametrize("text", TYPES)
def test_canonical_text_round_trips(text):
    assert str(parse_type(text)) == text and parse_type(str(parse_type(text))) == parse_type(text)


@pytest.mark.parametrize(
    "text",
    ["JSON", "Point", "IntervalDay", "AggregateFunction(sum, Int8)", "Nothing", "Int7", "Decimal(77, 0)", "Decimal(3, 4)", "DateTime64(10)", "Nullable(Array(Int8))", "Map(Nullable(String), Int8)", "Enum8('a' = 200)", "Enum8('a' = 1, 'b' = 1)", "Nested(Int8)", "Array(Int8", "FixedString(0)", ""],
)
def test_refused(text):
    with pytest.raises(UsageError):
        parse_type(text)


CASES = {
    "UInt8": (["0", "255", "007"], ["256", "-1", "", " 5", "+5", "5.0", "٣"]),
    "Int8": (["-128", "127", "-0"], ["-129", "128", "--1"]),
    "UInt256": ([str(2**256 - 1)], [str(2**256)]),
    "Int128": ([str(-(2**127))], [str(2**127), str(-(2**127) - 1)]),
    "Decimal(5, 2)": (["999.99", "-0.1", "000123"], ["1000", "1.234", ".5", "1.", "1e3"]),
    "Bool": (["0", "1"], ["2", "true", ""]),
    "Float32": (["0123abCD"], ["0123abC", "0123abCDE", "x123abCD"]),
    "Date": (["1970-01-01", "2149-06-06", "2024-02-29"], ["2149-06-07", "1969-12-31", "2023-02-29", "2024-2-01", "2024-01-01\n"]),
    "Date32": (["1900-01-01", "2299-12-31"], ["1899-12-31", "2300-01-01"]),
    "DateTime": (["0", "4294967295"], ["4294967296", "-1"]),
    "DateTime64(3)": (["2024-01-31 23:59:59.123"], ["2024-01-31 23:59:59.12", "2024-01-31 24:00:00.000", "2024-02-30 00:00:00.000", "2024-01-31 23:59:60.000"]),
    "DateTime64(0)": (["2024-01-31 23:59:59"], ["2024-01-31 23:59:59."]),
    "Enum8('a' = 1, 'b' = -2)": (["1", "-2"], ["a", "2", " 1"]),
    "UUID": (["123E4567-e89b-12d3-a456-426614174000"], ["123e4567e89b12d3a456426614174000"]),
    "IPv4": (["0.0.0.0", "255.255.255.255"], ["256.0.0.1", "01.2.3.4", "1.2.3"]),
    "IPv6": (["::", "2001:db8::1", "::ffff:1.2.3.4"], ["2001:DB8::1", "0:0:0:0:0:0:0:1", "::ffff:102:304", "x"]),
    "String": (["a\tb\nc\rd", "", "é"], ["a\x00", "\x1b["]),
    "FixedString(2)": (["00fF"], ["00f", "00ff0"]),
}


@pytest.mark.parametrize("kind", CASES)
def test_values(spark, kind):
    good, bad = CASES[kind]
    df = spark.createDataFrame([(x,) for x in good + bad], "x string").select("x", v.text_reason(F.col("x"), parse_type(kind)).alias("r"))
    got = {r.x: r.r for r in df.collect()}
    assert {x for x in got if got[x] is None} == set(good) and all(got[x] for x in bad)


def test_column_rules_come_in_order(spark):
    rule = ColumnContract("x", "Nullable(String)", max_len=3, pattern="^[a-z]*$", allowed=("a", "ab"), approved=("OK!!",))
    rows = [(None, None), ("a\x00", "control character"), ("abcd", "too long"), ("éé", "too long"), ("A", "breaks the pattern"), ("a\n", "breaks the pattern"), ("b", "not an allowed value"), ("a", None), ("OK!!", None)]
    df = spark.createDataFrame(rows, "x string, want string").select("want", v.column_reason(F.col("x"), rule).alias("got"))
    assert all(r.want == r.got for r in df.collect())


def test_nested_opaque_and_packed(spark):
    df = spark.createDataFrame([([1, None],), ([1, 2, 3],), (None,)], "a array<int>")
    assert [r.r for r in df.select(v.nested_reason(F.col("a"), max_elements=2, nullable_elements=False).alias("r")).collect()] == ["null element", "too many elements", None]
    keys = spark.createDataFrame([("11111111111111111111111111111111",), ("",), ("0OIl",), ("2",)], "k string")
    assert [r.r for r in keys.select(v.opaque(F.col("k"), 32, empty=True).alias("r")).collect()] == [None, None, "not 32 bytes", "not 32 bytes"]
    assert [r.r for r in keys.select(v.opaque(F.col("k"), 32).alias("r")).collect()] == [None, "not 32 bytes", "not 32 bytes", "not 32 bytes"]
    packed = spark.createDataFrame([("AAAA",), ("AAA=",), ("",), ("AAAAA",)], "p string")
    assert [r.r for r in packed.select(v.packed_base64(F.col("p"), [3]).alias("r")).collect()] == [None, "not a packed value", None, "not a packed value"]
    times = spark.sql("select timestamp '2024-01-01 00:00:00.123456' as t union all select timestamp '2024-01-01 00:00:00.123'")
    assert sorted(str(r.r) for r in times.select(v.scale_loss(F.col("t"), 3).alias("r")).collect()) == ["None", "more than 3 fraction digits"]
    lists = spark.createDataFrame([("[1,2]",), ("[1,null]",), ("[1,2,3]",), ("{}",), ('["x"]',)], "j string")
    assert [r.r for r in lists.select(v.json_array(F.col("j"), 2, "^[0-9]+$", False).alias("r")).collect()] == [None, "null element", "too many elements", "not a JSON array", "element breaks its rule"]


def test_contract_documents():
    text = 'table = "t"\norder_by = ["ts", "id"]\n[limits]\nmax_elements = 5\n[[columns]]\nname = "ts"\ntype = "DateTime"\n[[columns]]\nname = "id"\ntype = "Nullable(Int64)"\n'
    contract = load_contract(text)
    assert contract.limits.max_elements == 5 and cursor_columns(contract) == ["ts"] and len(contract.digest) == 64
    for bad in (text + "typo = 1\n", text.replace("max_elements = 5", "max_elements = 0"), text.replace("max_elements", "max_elephants"), text.replace('["ts", "id"]', '["gone"]')):
        with pytest.raises(UsageError):
            load_contract(bad)
    with pytest.raises(UsageError):
        cursor_columns(TableContract("t", (ColumnContract("id", "Nullable(Int8)"),), order_by=("id",)))
    with pytest.raises(UsageError):
        ColumnContract("x", "String", pattern="abc$")
    with pytest.raises(UsageError):
        Limits(max_decode_rounds=0)
