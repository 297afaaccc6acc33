"""Checks of values against declared types, as expressions that give a reason or null."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from tessera.contracts import ColumnContract, Limits
from tessera.types import Declared

_DAY = r"[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])"


def _all(*tests: tuple[Column, str]) -> Column:
    """The reason of the first test that fails; null if none does."""
    return F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for ok, reason in tests), F.lit(None).cast("string"))


def integer_in_range(c: Column, low: int, high: int) -> Column:
    """Digits of any length within bounds, compared as text after leading zeros go, for they can pass every integer type."""
    negative = c.startswith("-")
    digits = F.regexp_replace(F.regexp_replace(c, "^-", ""), "^0+(?=[0-9])", "")

    def at_most(bound: int) -> Column:
        text = str(abs(bound))
        return (F.length(digits) < len(text)) | ((F.length(digits) == len(text)) & (digits <= text))

    below = at_most(low) if low < 0 else digits == "0"
    return _all((c.rlike(r"^-?[0-9]{1,78}\z" if low < 0 else r"^[0-9]{1,78}\z"), "not an integer"), (F.when(negative, below).otherwise(at_most(high)), "integer out of range"))


def decimal_shape(c: Column, precision: int, scale: int) -> Column:
    whole = F.regexp_replace(F.regexp_extract(c, r"^-?([0-9]+)", 1), "^0+", "")
    part = F.regexp_extract(c, r"\.([0-9]+)\z", 1)
    return _all((c.rlike(r"^-?[0-9]+(\.[0-9]+)?\z"), "not a decimal"), (F.length(whole) <= precision - scale, "decimal too large"), (F.length(part) <= scale, "too many fraction digits"))


def hex_width(c: Column, digits: int) -> Column:
    return _all((c.rlike(rf"^[0-9a-fA-F]{{{digits}}}\z"), f"not {digits} hex digits"))


def calendar_date(c: Column, first: str, last: str) -> Column:
    return _all((c.rlike(rf"^{_DAY}\z"), "not a date"), (c.try_cast("date").isNotNull(), "no such day"), (c.between(first, last), "date out of range"))


def unix_seconds(c: Column) -> Column:
    return integer_in_range(c, 0, 4294967295)


def date_time_64(c: Column, digits: int) -> Column:
    tail = rf"\.[0-9]{{{digits}}}" if digits else ""
    return _all((c.rlike(rf"^{_DAY} ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]{tail}\z"), f"not a time with {digits} fraction digits"), (F.substring(c, 1, 10).try_cast("date").isNotNull(), "no such day"))


def enum_id(c: Column, ids: list[int]) -> Column:
    return _all((c.rlike(r"^-?[0-9]{1,5}\z"), "not an enum id"), (c.try_cast("int").isin(ids), "unknown enum id"))


def uuid(c: Column) -> Column:
    return _all((c.rlike(r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}\z"), "not a UUID"))


def ipv4(c: Column) -> Column:
    octet = "(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    return _all((c.rlike(rf"^({octet}\.){{3}}{octet}\z"), "not a canonical IPv4 address"))


def canonical_ipv6(text: str) -> str | None:
    """The one way to write an address, with an embedded IPv4 address in dotted form; None if it is none."""
    try:
        address = ipaddress.IPv6Address(text)
    except ValueError:
        return None
    mapped = address.ipv4_mapped
    return f"::ffff:{mapped}" if mapped is not None else address.compressed


def ipv6(c: Column) -> Column:
    @F.pandas_udf("boolean")
    def canonical(values: pd.Series) -> pd.Series:
        return values.map(lambda v: v is not None and "%" not in v and canonical_ipv6(v) == v)

    return _all((canonical(c), "not a canonical IPv6 address"))


def free_text(c: Column) -> Column:
    """Control characters other than tab, line feed and carriage return."""
    return _all((~c.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F]"), "control character"))


def utf8(c: Column) -> Column:
    return _all((F.call_function("is_valid_utf8", c.cast("string")), "not UTF-8"))


def json_array(c: Column, cap: int, element: str | None, nullable: bool) -> Column:
    """A JSON array of scalars as text: element cap, nulls, and a pattern for every element."""
    items = F.from_json(c, "array<string>")
    tests = [(F.json_array_length(c).isNotNull(), "not a JSON array"), (F.json_array_length(c) <= cap, "too many elements")]
    if not nullable:
        tests.append((~F.exists(items, lambda x: x.isNull()), "null element"))
    if element is not None:
        tests.append((F.forall(items, lambda x: x.isNull() | x.rlike(element)), "element breaks its rule"))
    return _all(*tests)


def scale_loss(c: Column, digits: int) -> Column:
    """A timestamp with more precision than its declared number of fraction digits."""
    step = 10 ** max(0, 6 - digits)
    return _all((F.unix_micros(c) % step == 0, f"more than {digits} fraction digits"))


_B58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def base58(text: str) -> bytes | None:
    """The bytes of a base58 text; None for a character outside its alphabet."""
    number = 0
    for c in text:
        if (digit := _B58.find(c)) < 0:
            return None
        number = number * 58 + digit
    zeros = len(text) - len(text.lstrip("1"))
    return b"\0" * zeros + number.to_bytes((number.bit_length() + 7) // 8, "big")


def opaque(c: Column, size: int, spellings: str = "base58", *, empty: bool = False) -> Column:
    """A text that stands for exactly ``size`` bytes in base58, or also in canonical base64; the empty text only where ``empty`` allows it, as signatures and public keys do."""

    @F.pandas_udf("boolean")
    def holds(values: pd.Series) -> pd.Series:
        from tessera.functions.payloads import strict_base64

        def one(v: str | None) -> bool:
            if v == "":
                return empty
            if v is None or len(v) > 2 * size:
                return False
            forms = [base58(v)] + ([strict_base64(v.encode())] if spellings != "base58" else [])
            return any(f is not None and len(f) == size for f in forms)

        return values.map(one)

    return _all((holds(c), f"not {size} bytes"))


def packed_base64(c: Column, sizes: list[int]) -> Column:
    """Standard base64 of exactly one of the sizes in bytes; empty is allowed."""
    size = F.length(F.try_to_binary(c, F.lit("base64")))
    return _all(((c == "") | (c.rlike(r"^[A-Za-z0-9+/]+={0,2}\z") & (F.length(c) % 4 == 0) & F.coalesce(size.isin(sizes), F.lit(False))), "not a packed value"))


def text_reason(c: Column, t: Declared) -> Column:
    """Why a text is not a value of a declared scalar type; null if it is one."""
    if t.name in ("Nullable", "LowCardinality"):
        return text_reason(c, t.inner[0])
    if t.labels:
        return enum_id(c, [i for _, i in t.labels])
    if t.bounds is not None:
        return integer_in_range(c, *t.bounds)
    simple = {
        "Bool": lambda: _all((c.isin("0", "1"), "not 0 or 1")),
        "Float32": lambda: hex_width(c, 8),
        "Float64": lambda: hex_width(c, 16),
        "Date": lambda: calendar_date(c, "1970-01-01", "2149-06-06"),
        "Date32": lambda: calendar_date(c, "1900-01-01", "2299-12-31"),
        "DateTime": lambda: unix_seconds(c),
        "UUID": lambda: uuid(c),
        "IPv4": lambda: ipv4(c),
        "IPv6": lambda: ipv6(c),
        "String": lambda: free_text(c),
        "FixedString": lambda: hex_width(c, 2 * t.args[0]),
        "DateTime64": lambda: date_time_64(c, t.args[0]),
        "Decimal": lambda: decimal_shape(c, *t.args),
    }
    return simple[t.name]()


def column_reason(c: Column, contract: ColumnContract, *, text: bool = True) -> Column:
    """The first reason against a value: null, type, byte cap, pattern, allowed values; null if there is none.

    ``text``: the column holds the type's text form; otherwise it has the
    native type, and only what Spark's types leave open is checked.
    """
    t = contract.declared
    leaf = t.inner[0] if t.name in ("Nullable", "LowCardinality") else t
    tests = []
    if text or leaf.name == "String":
        tests.append(text_reason(c, leaf))
    cap = contract.max_len
    if cap is not None:
        tests.append(_all((F.octet_length(c.cast("string")) <= cap, "too long")))
    if contract.pattern is not None:
        anchored = contract.pattern[:-1] + r"\z" if contract.pattern.endswith("$") else contract.pattern
        tests.append(_all((c.rlike(anchored), "breaks the pattern")))
    if contract.allowed:
        tests.append(_all((c.isin(*contract.allowed), "not an allowed value")))
    reason = F.coalesce(*tests, F.lit(None).cast("string"))
    if contract.approved:
        reason = F.when(c.isin(*contract.approved), F.lit(None)).otherwise(reason)
    return F.when(c.isNull(), F.lit(None if contract.nullable else "null in a column without nulls")).otherwise(reason)


def nested_reason(c: Column, *, max_elements: int, max_bytes: int | None = None, nullable_elements: bool = True) -> Column:
    """Caps of an array: elements, nulls among them, and bytes of all elements together."""
    tests = [(F.size(c) <= max_elements, "too many elements")]
    if not nullable_elements:
        tests.append((~F.exists(c, lambda x: x.isNull()), "null element"))
    if max_bytes is not None:
        total = F.aggregate(F.transform(c, lambda x: F.coalesce(F.octet_length(x.cast("string")), F.lit(0))), F.lit(0), lambda a, b: a + b)
        tests.append((total <= max_bytes, "too many bytes"))
    return F.when(c.isNotNull(), _all(*tests))


def equal_lengths(*arrays: Column) -> Column:
    """Parallel arrays of one map or nested column have the same length."""
    same = F.lit(True)
    for other in arrays[1:]:
        same = same & F.size(arrays[0]).eqNullSafe(F.size(other))
    return _all((same, "lengths differ"))


def nested(kind: DataType) -> bool:
    return isinstance(kind, (ArrayType, MapType, StructType))


def walk_reason(c: Column, kind: DataType, limits: Limits) -> Column:
    """The first reason against what a nested value holds: too many elements of an array or map, a null that its type
    does not allow, a control character or too many bytes in a text, at any depth; null if there is none."""
    if isinstance(kind, ArrayType):
        inside = F.filter(F.transform(c, lambda x: F.coalesce(walk_reason(x, kind.elementType, limits), F.when(x.isNull(), F.lit(None if kind.containsNull else "null element")))), lambda r: r.isNotNull())
        return F.when(F.size(c) > limits.max_elements, "too many elements").otherwise(F.get(inside, F.lit(0)))
    if isinstance(kind, MapType):
        parts = (walk_reason(F.map_keys(c), ArrayType(kind.keyType, False), limits), walk_reason(F.map_values(c), ArrayType(kind.valueType, kind.valueContainsNull), limits))
        return F.coalesce(*parts)
    if isinstance(kind, StructType):
        return F.coalesce(*(walk_reason(c[f.name], f.dataType, limits) for f in kind.fields), F.lit(None).cast("string"))
    if isinstance(kind, StringType):
        return F.when(c.isNotNull(), F.coalesce(F.when(F.octet_length(c) > limits.max_field_bytes, "too long"), free_text(c)))
    return F.lit(None).cast("string")


def texts_in(c: Column, kind: DataType) -> Column:
    """All texts in a nested value, each on lines of its own, in order; null if it has no place for any."""
    if isinstance(kind, ArrayType):
        return F.array_join(F.transform(c, lambda x: texts_in(x, kind.elementType)), "\n")
    if isinstance(kind, MapType):
        return F.concat_ws("\n", texts_in(F.map_keys(c), ArrayType(kind.keyType)), texts_in(F.map_values(c), ArrayType(kind.valueType)))
    if isinstance(kind, StructType):
        return F.concat_ws("\n", *(texts_in(c[f.name], f.dataType) for f in kind.fields))
    return c if isinstance(kind, StringType) else F.lit(None).cast("string")
