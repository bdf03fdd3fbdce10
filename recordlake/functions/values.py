"""Dynamic values: kinds, the JSON bridge, durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Milliseconds per duration unit.
UNIT_MS = {"DAY": 86_400_000, "HOUR": 3_600_000, "MINUTE": 60_000, "SECOND": 1_000}


def let(value: Column, body) -> Column:
    """Bind a value once inside an expression, so that ``body`` may use it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kind_from(shape: Column, value: Column, json_source: bool = True) -> Column:
    """The kind name of a VARIANT whose ``schema_of_variant`` text is ``shape``."""
    wide = F.try_variant_get(value, "$", "bigint")
    integer = F.when(wide.between(-(2**31), 2**31 - 1), F.lit("int32")).otherwise(F.lit("int64"))
    return (
        F.when(shape.isNull(), F.lit("absent"))
        .when(shape == "BIGINT", integer)
        .when(shape == "STRING", F.lit("string"))
        .when(shape == "VOID", F.lit("null"))
        .when(shape == "BOOLEAN", F.lit("bool"))
        .when(shape == "DOUBLE", F.lit("double"))
        .when(shape.startswith("DECIMAL"), F.lit("double" if json_source else "decimal"))
        .when(shape.startswith("ARRAY"), F.lit("list"))
        .when(shape.startswith("OBJECT"), F.lit("map"))
        .when(shape == "FLOAT", F.lit("float"))
        .when(shape == "BINARY", F.lit("bytes"))
        .otherwise(F.lit("timestamp"))
    )


def kind_of(value: Column, json_source: bool = True) -> Column:
    """The kind name of a VARIANT: null, bool, int32, int64, float, double, string, ...

    JSON has one number type, so for JSON input a real, or an integer past 64 bits, is a double.
    """
    return let(value, lambda v: let(F.schema_of_variant(v), lambda s: kind_from(s, v, json_source)))


def rfc3339(ts: Column) -> Column:
    """A timestamp (session zone UTC) as RFC 3339 text: ``2024-01-01T00:00:00+00:00``, fraction only if non-zero."""
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    fraction = (
        F.when(micros == "000000", F.lit(""))
        .when(micros.endswith("000"), F.concat(F.lit("."), F.substring(micros, 1, 3)))
        .otherwise(F.concat(F.lit("."), micros))
    )
    return F.concat(base, fraction, F.lit("+00:00"))


def duration_ms(text: Column) -> Column:
    """``<n> DAYS|HOURS|MINUTES|SECONDS`` (singular too, any case) to milliseconds, else null."""
    pattern = r"^\s*([+-]?\d+)\s+([A-Za-z]+?)[sS]*(?:\s.*)?$"
    amount = F.regexp_extract(text, pattern, 1).try_cast("bigint")
    unit = F.upper(F.regexp_extract(text, pattern, 2))
    factor = F.lit(None).cast("bigint")
    for name, ms in UNIT_MS.items():
        factor = F.when(unit == name, F.lit(ms).cast("bigint")).otherwise(factor)
    return F.try_multiply(amount, factor)


def duration_ms_of(text: str | None) -> int | None:
    """The same rule for one text on the driver (specs, not data)."""
    import re

    found = re.match(r"^\s*([+-]?\d+)\s+([A-Za-z]+?)[sS]*(?:\s.*)?$", text or "")
    unit = UNIT_MS.get(found.group(2).upper()) if found else None
    return int(found.group(1)) * unit if unit else None


def parse_value(text: Column) -> Column:
    """JSON text to a dynamic value; JSON null gives SQL null, broken text gives null."""
    value = F.try_parse_json(text)
    return F.when(~F.is_variant_null(value), value)


def number_kind(text: Column) -> Column:
    """The kind a JSON number gets: the smallest of int32, int64, double."""
    return kind_of(F.try_parse_json(text))


def json_ready(value: Column, data_type: str) -> Column:
    """One typed column in the form it takes inside JSON text.

    float widens to double, bytes become a list of ints, timestamps and dates RFC 3339 text, links
    rid text; a scale-0 decimal is a number, any other its ``<unscaled>e-<scale>`` text.
    """
    from recordlake.functions.links import link_text

    if data_type == "float":
        return value.cast("double")
    if data_type == "binary":
        return bytes_to_ints(value)
    if data_type in ("timestamp", "timestamp_ntz", "date"):
        return rfc3339(value)
    if data_type == "struct<bucket:int,pos:bigint>":
        return link_text(value)
    if data_type.startswith("decimal"):
        scale = int(data_type[:-1].split(",")[1])
        return value if scale == 0 else decimal_text(value, F.lit(scale))
    return value


def decimal_text(value: Column, scale: Column) -> Column:
    """A decimal as ``<unscaled>e-<scale>`` text, exact at any width."""
    digits = F.replace(value.cast("string"), F.lit("."), F.lit("")).cast("decimal(38,0)")
    return F.concat(digits.cast("string"), F.lit("e-"), scale.cast("string"))


def bytes_to_ints(value: Column) -> Column:
    """Binary to an array of ints 0-255."""
    text = F.hex(value)
    size = F.length(value)
    positions = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    return F.when(
        value.isNotNull(),
        F.transform(positions, lambda i: F.conv(F.substring(text, i * 2 + 1, F.lit(2)), 16, 10).cast("int")),
    )


def ints_to_bytes(items: Column) -> Column:
    """An array of ints 0-255 to binary; any other element makes the whole value null."""
    ok = F.forall(items, lambda x: x.between(0, 255))
    return F.when(ok, F.unhex(F.array_join(F.transform(items, lambda x: F.lpad(F.hex(x), 2, "0")), "")))
