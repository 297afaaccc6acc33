"""Schemas as relations: inference, comparison, agreement, projection onto a target."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.contracts import ColumnContract, TableContract
from tessera.errors import FindingError, UsageError
from tessera.types import Declared, spark_type

SCHEMA = "position int, name string, type string, nullable boolean"


def relation(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A schema as rows."""
    return spark.createDataFrame([(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(schema)], SCHEMA)


def cross_check(pinned: DataFrame, observed: DataFrame) -> DataFrame:
    """position, pinned and observed name and type wherever two schemas differ by position."""
    a = pinned.select("position", F.col("name").alias("pinned_name"), F.col("type").alias("pinned_type"))
    b = observed.select("position", F.col("name").alias("observed_name"), F.col("type").alias("observed_type"))
    same = F.col("pinned_name").eqNullSafe(F.col("observed_name")) & F.col("pinned_type").eqNullSafe(F.col("observed_type"))
    return a.join(b, "position", "full_outer").filter(~same)


def drift(source: DataFrame, target: DataFrame) -> DataFrame:
    """name, outcome of each column of either schema: same, widened, tightened, retyped, padded, extra."""
    a = source.select("name", F.col("type").alias("s"), F.col("nullable").alias("sn"))
    b = target.select("name", F.col("type").alias("t"), F.col("nullable").alias("tn"))
    outcome = (
        F.when(F.col("t").isNull(), "extra")
        .when(F.col("s").isNull(), "padded")
        .when(F.col("s") != F.col("t"), "retyped")
        .when(F.col("sn") & ~F.col("tn"), "tightened")
        .when(~F.col("sn") & F.col("tn"), "widened")
        .otherwise("same")
    )
    return a.join(b, "name", "full_outer").select("name", outcome.alias("outcome"))


def project(df: DataFrame, target: T.StructType, *, reviewed: set[str] = frozenset(), drop: set[str] = frozenset()) -> tuple[DataFrame, list[str]]:
    """``df`` in the target's columns and order, and the names of columns padded with null.

    A missing column is padded if the target allows null and it was not
    reviewed; an extra one that is not dropped, another type, or a needed
    column that is missing is a finding. Field metadata is left behind.
    """
    have = {f.name: f for f in df.schema}
    if extra := [n for n in have if n not in target.names and n not in drop]:
        raise FindingError(f"columns the target does not have: {', '.join(extra)}")
    columns, padded = [], []
    for field in target:
        if field.name not in have:
            if not field.nullable or field.name in reviewed:
                raise FindingError(f"{field.name} is missing and may not be padded")
            padded.append(field.name)
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif have[field.name].dataType != field.dataType:
            raise FindingError(f"{field.name} is {have[field.name].dataType.simpleString()}, not {field.dataType.simpleString()}")
        else:
            columns.append(F.col(f"`{field.name}`").alias(field.name, metadata={}))
    return df.select(*columns), padded


def target_schema(contract: TableContract, observed: list[T.StructType]) -> T.StructType:
    """Columns and order of the contract; a column any observed schema lacks or allows null in is nullable."""
    fields = []
    for c in contract.kept:
        seen = [next((f for f in s if f.name == c.name), None) for s in observed]
        kind = next((f.dataType for f in seen if f is not None), spark_type(c.declared))
        fields.append(T.StructField(c.name, kind, c.nullable or any(f is None or f.nullable for f in seen)))
    return T.StructType(fields)


def agreed(schemas: list[T.StructType], most: int = 16) -> T.StructType:
    """The one schema of all files; more than one distinct is a finding that names how many."""
    distinct = {s.json(): s for s in schemas}
    if len(distinct) != 1:
        raise FindingError(f"{min(len(distinct), most)} different schemas among the files")
    return next(iter(distinct.values()))


def schema_hash(schema: T.StructType) -> str:
    return hashlib.sha256(json.dumps(json.loads(schema.json()), sort_keys=True).encode()).hexdigest()


_NATIVE = {"string": "String", "boolean": "Bool", "tinyint": "Int8", "smallint": "Int16", "int": "Int32", "bigint": "Int64", "float": "Float32", "double": "Float64", "date": "Date32", "binary": "String"}


def infer_type(kind: T.DataType) -> str:
    """The declared type that an observed type stands for; usage error if none does without doubt."""
    if isinstance(kind, T.ArrayType):
        inner = infer_type(kind.elementType)
        return f"Array({f'Nullable({inner})' if kind.containsNull and not isinstance(kind.elementType, T.ArrayType | T.StructType | T.MapType) else inner})"
    if isinstance(kind, T.MapType):
        return f"Map({infer_type(kind.keyType)}, {infer_type(kind.valueType)})"
    if isinstance(kind, T.StructType):
        return f"Tuple({', '.join(f'{f.name} {infer_type(f.dataType)}' for f in kind)})"
    if isinstance(kind, T.DecimalType):
        return f"Decimal({kind.precision}, {kind.scale})"
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return "DateTime64(6)"
    if (name := _NATIVE.get(kind.simpleString())) is None:
        raise UsageError(f"no declared type for {kind.simpleString()}")
    return name


def infer_contract(table: str, schema: T.StructType) -> TableContract:
    columns = []
    for f in schema:
        name = infer_type(f.dataType)
        composite = name.split("(")[0] in ("Array", "Map", "Tuple", "Nested")
        columns.append(ColumnContract(f.name, f"Nullable({name})" if f.nullable and not composite else name, freedom="open" if name == "String" else "closed"))
    return TableContract(table, tuple(columns))


def compatible(declared: Declared, kind: T.DataType) -> bool:
    """May a column of this Spark type hold a declared type's values natively?"""
    want = spark_type(declared)
    if isinstance(want, T.ArrayType) and isinstance(kind, T.ArrayType):
        inner = declared.inner[0] if declared.name in ("Array", "Nullable", "LowCardinality") else None
        return inner is None or compatible(inner, kind.elementType)
    if declared.labels and isinstance(kind, T.StringType):
        return True
    if isinstance(want, T.TimestampType) and isinstance(kind, T.TimestampNTZType):
        return True
    return want.simpleString() == kind.simpleString()


def flattened(contract: TableContract) -> list[str]:
    """Names of the leaf columns after tuples and nested columns unfold; a collision is a usage error."""
    out: list[str] = []

    def leaves(prefix: str, t: Declared) -> None:
        if t.name in ("Tuple", "Nested"):
            for i, inner in enumerate(t.inner):
                leaves(f"{prefix}.{t.names[i] if t.names else i + 1}", inner)
        elif t.name == "Map":
            out.extend([f"{prefix}.keys", f"{prefix}.values"])
        else:
            out.append(prefix)

    for c in contract.kept:
        leaves(c.name, c.declared)
    if len(set(out)) < len(out):
        raise UsageError(f"{contract.table}: flattened names collide")
    return out


def field_report(spark: SparkSession, contract: TableContract) -> DataFrame:
    """One row per column: how it is checked."""
    rows = [(c.name, str(c.declared), c.nullable, c.freedom, c.max_len, c.pattern, len(c.allowed), c.drop) for c in contract.columns]
    return spark.createDataFrame(rows, "name string, type string, nullable boolean, freedom string, max_len int, pattern string, allowed int, dropped boolean")
