"""Declared column types: parsing, canonical text, Spark types and value ranges."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

from tessera.errors import UsageError

_REFUSED = re.compile(r"(Point|Ring|LineString|MultiLineString|Polygon|MultiPolygon|JSON|Object|Dynamic|Variant|AggregateFunction|SimpleAggregateFunction|Interval\w*|Nothing)\b")
_INTEGER = re.compile(r"(U?)Int(8|16|32|64|128|256)")
_PLAIN = {"String", "Date", "Date32", "UUID", "IPv4", "IPv6", "Bool", "Float32", "Float64"}
_WIDTH = {"Decimal32": 9, "Decimal64": 18, "Decimal128": 38, "Decimal256": 76}


@dataclass(frozen=True)
class Declared:
    """A type: ``name``, numeric arguments, inner types and their names, enum ids by label."""

    name: str
    args: tuple[int, ...] = ()
    inner: tuple[Declared, ...] = ()
    names: tuple[str, ...] = ()
    labels: tuple[tuple[str, int], ...] = field(default=())

    def __str__(self) -> str:
        if self.labels:
            return f"{self.name}({', '.join(f'{_quoted(k)} = {v}' for k, v in self.labels)})"
        if self.names:
            return f"{self.name}({', '.join(f'{n} {t}' for n, t in zip(self.names, self.inner, strict=True))})"
        parts = [str(x) for x in (*self.args, *self.inner)]
        return f"{self.name}({', '.join(parts)})" if parts else self.name

    @property
    def depth(self) -> int:
        return 1 + max((t.depth for t in self.inner), default=0)

    @property
    def nullable(self) -> bool:
        return self.name == "Nullable"

    @property
    def bounds(self) -> tuple[int, int] | None:
        """Least and greatest value of an integer or enum type."""
        if m := _INTEGER.fullmatch(self.name):
            bits = int(m[2])
            return (0, (1 << bits) - 1) if m[1] else (-(1 << (bits - 1)), (1 << (bits - 1)) - 1)
        return {"Enum8": (-128, 127), "Enum16": (-32768, 32767)}.get(self.name)


def _quoted(label: str) -> str:
    return "'" + label.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _split(text: str) -> list[str]:
    """Parts between commas outside brackets and quotes."""
    parts, depth, start, quoted, i = [], 0, 0, False, 0
    while i < len(text):
        c = text[i]
        if quoted and c == "\\":
            i += 1
        elif c == "'":
            quoted = not quoted
        elif not quoted and c in "()":
            depth += 1 if c == "(" else -1
        elif not quoted and c == "," and depth == 0:
            parts.append(text[start:i])
            start = i + 1
        i += 1
    if depth or quoted:
        raise UsageError(f"unbalanced type: {text}")
    return [p.strip() for p in [*parts, text[start:]]]


def parse_type(text: str, depth: int = 0) -> Declared:
    """A declared type from its text; anything unknown, refused or malformed is a usage error that says why."""
    text = text.strip()
    if depth > 16:
        raise UsageError("type is nested too deeply")
    if m := _REFUSED.match(text):
        raise UsageError(f"{m[1]} is not supported")
    name, _, rest = text.partition("(")
    name = {"Boolean": "Bool", "Decimal": "Decimal"}.get(name.strip(), name.strip())
    if rest and not rest.endswith(")"):
        raise UsageError(f"malformed type: {text}")
    args = _split(rest[:-1]) if rest else []
    if not args and (name in _PLAIN or _INTEGER.fullmatch(name)):
        return Declared(name)
    if name in ("Nullable", "LowCardinality", "Array") and len(args) == 1:
        inner = parse_type(args[0], depth + 1)
        if name == "Nullable" and inner.name in ("Array", "Map", "Tuple", "Nested", "Nullable", "LowCardinality"):
            raise UsageError(f"Nullable may not wrap {inner.name}")
        return Declared(name, inner=(inner,))
    if name == "Map" and len(args) == 2:
        inner = tuple(parse_type(a, depth + 1) for a in args)
        if inner[0].nullable:
            raise UsageError("a map's key may not be Nullable")
        return Declared(name, inner=inner)
    if name in ("Tuple", "Nested") and args:
        named = [re.fullmatch(r"([A-Za-z_]\w*)\s+(.+)", a, re.DOTALL) for a in args]
        if name == "Nested" and not all(named):
            raise UsageError("Nested needs a name for each element")
        if all(named) and len({m[1] for m in named}) < len(named):
            raise UsageError("an element's name repeats")
        if all(named):
            return Declared(name, inner=tuple(parse_type(m[2], depth + 1) for m in named), names=tuple(m[1] for m in named))
        return Declared(name, inner=tuple(parse_type(a, depth + 1) for a in args))
    if name in ("Enum", "Enum8", "Enum16") and args:
        pairs = [re.fullmatch(r"'((?:[^'\\]|\\.)*)'\s*=\s*(-?\d+)", a) for a in args]
        if not all(pairs):
            raise UsageError(f"malformed enum: {text}")
        labels = tuple((re.sub(r"\\(.)", r"\1", m[1]), int(m[2])) for m in pairs)
        name = name if name != "Enum" else "Enum8" if all(-128 <= i <= 127 for _, i in labels) else "Enum16"
        low, high = Declared(name).bounds
        if len({i for _, i in labels}) < len(labels) or len({k for k, _ in labels}) < len(labels):
            raise UsageError("an enum's id or label repeats")
        if not all(low <= i <= high for _, i in labels):
            raise UsageError("an enum's id is out of range")
        return Declared(name, labels=labels)
    if name == "DateTime" and len(args) <= 1:
        return Declared(name)
    if name == "DateTime64" and 1 <= len(args) <= 2 and args[0].isdecimal() and int(args[0]) <= 9:
        return Declared(name, (int(args[0]),))
    if name == "FixedString" and len(args) == 1 and args[0].isdecimal() and int(args[0]) > 0:
        return Declared(name, (int(args[0]),))
    if name == "Decimal" and len(args) == 2 and all(a.isdecimal() for a in args):
        precision, scale = map(int, args)
        if 1 <= precision <= 76 and scale <= precision:
            return Declared(name, (precision, scale))
    if name in _WIDTH and len(args) == 1 and args[0].isdecimal() and int(args[0]) <= _WIDTH[name]:
        return Declared("Decimal", (_WIDTH[name], int(args[0])))
    raise UsageError(f"unknown type: {text}")


def spark_type(t: Declared) -> T.DataType:
    """The Spark type that holds a declared type's values; text where none is wide enough."""
    if t.name in ("Nullable", "LowCardinality"):
        return spark_type(t.inner[0])
    if t.name == "Array":
        return T.ArrayType(spark_type(t.inner[0]), t.inner[0].nullable)
    if t.name == "Map":
        return T.MapType(spark_type(t.inner[0]), spark_type(t.inner[1]), t.inner[1].nullable)
    if t.name in ("Tuple", "Nested"):
        names = t.names or tuple(f"_{i + 1}" for i in range(len(t.inner)))
        row = T.StructType([T.StructField(n, spark_type(x), x.nullable) for n, x in zip(names, t.inner, strict=True)])
        return row if t.name == "Tuple" else T.ArrayType(row, False)
    if t.name == "Decimal":
        return T.DecimalType(*t.args) if t.args[0] <= 38 else T.StringType()
    fixed = {"Int8": T.ByteType(), "Int16": T.ShortType(), "Int32": T.IntegerType(), "Int64": T.LongType(), "UInt8": T.ShortType(), "UInt16": T.IntegerType(), "UInt32": T.LongType(), "UInt64": T.DecimalType(20, 0)}
    fixed |= {"Float32": T.FloatType(), "Float64": T.DoubleType(), "Bool": T.BooleanType(), "Date": T.DateType(), "Date32": T.DateType(), "DateTime": T.TimestampType(), "DateTime64": T.TimestampType(), "Enum8": T.ByteType(), "Enum16": T.ShortType(), "FixedString": T.BinaryType()}
    return fixed.get(t.name, T.StringType())
