"""Forms in which values leave: canonical text, bits, hex, parallel arrays, tab-separated rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def float_bits(c: Column, width: int = 64) -> Column:
    """The IEEE bits of a number as hex of fixed width; sign of zero and payload of NaN are kept; null stays null."""
    # The method behind reflect() takes no null.
    held = F.coalesce(c, F.lit(0.0))
    if width == 64:
        bits = F.lpad(F.lower(F.hex(F.reflect(F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), held.cast("double")).cast("bigint"))), 16, "0")
    else:
        raw = F.reflect(F.lit("java.lang.Float"), F.lit("floatToRawIntBits"), held.cast("float")).cast("int").cast("bigint")
        bits = F.lpad(F.lower(F.hex(raw.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")
    return F.when(c.isNotNull(), bits)


def utc_text(c: Column, digits: int) -> Column:
    """A timestamp with a fixed number of fraction digits."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss" + ("." + "S" * digits if digits else ""))


def sorted_entries(m: Column) -> Column:
    """A map's entries by key; keys and values are taken from this, so that they stay parallel."""
    return F.array_sort(F.map_entries(m))


def map_keys_sorted(m: Column) -> Column:
    return F.transform(sorted_entries(m), lambda e: e["key"])


def map_values_sorted(m: Column) -> Column:
    return F.transform(sorted_entries(m), lambda e: e["value"])


def json_array_text(c: Column, element=lambda x: x) -> Column:
    return F.to_json(F.transform(c, element))


def nested_field(c: Column, name: str) -> Column:
    return F.transform(c, lambda e: e[name])


#: Byte and how it is written; the backslash comes first, for the others add some.
ESCAPES = (("\\", "\\\\"), ("\b", "\\b"), ("\f", "\\f"), ("\r", "\\r"), ("\n", "\\n"), ("\t", "\\t"), ("\0", "\\0"), ("'", "\\'"))


def tsv_field(c: Column) -> Column:
    r"""A field of a tab-separated row; null is ``\N``, which no escaped text can be."""
    out = c.cast("string")
    for raw, written in ESCAPES:
        out = F.replace(out, F.lit(raw), F.lit(written))
    return F.coalesce(out, F.lit("\\N"))


def tsv_row(*columns: Column) -> Column:
    return F.concat_ws("\t", *(tsv_field(c) for c in columns))


def display(c: Column) -> Column:
    """Text for a report: control characters written as escapes."""
    out = F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\"))
    for raw, written in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(written))
    return F.regexp_replace(out, r"[\x00-\x1F\x7F]", "?")
