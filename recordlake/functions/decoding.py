"""Typed reads of one dynamic value: a value column and an error column, all native expressions.

An error is STRUCT<path, code, expected, actual, message>; null means the value is good. Codes:
missing_field, type_mismatch, conversion.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlake.functions.links import parse_link
from recordlake.functions.values import decimal_text, ints_to_bytes, kind_from, let, rfc3339
from recordlake.model import Custom, DecimalOf, FieldSpec, ListOf, MapOf, Newtype, RecordSpec, Scalar, SetOf

ERROR_TYPE = "struct<path:string,code:string,expected:string,actual:string,message:string>"

# Integer targets, their ranges and the Spark type that holds them.
INT_TARGETS = {
    "i8": (-128, 127, "tinyint"),
    "i16": (-32768, 32767, "smallint"),
    "i32": (-2147483648, 2147483647, "int"),
    "i64": (-9223372036854775808, 9223372036854775807, "bigint"),
    "u8": (0, 255, "smallint"),
    "u16": (0, 65535, "int"),
    "u32": (0, 4294967295, "bigint"),
    "u64": (0, 9223372036854775807, "bigint"),
}
# The text form of a date-time with offset.
RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def error(path: Column, code: str, expected=None, actual=None, message=None) -> Column:
    def text(x):
        return x if isinstance(x, Column) else F.lit(x).cast("string")

    return F.struct(
        path.alias("path"), F.lit(code).alias("code"), text(expected).alias("expected"),
        text(actual).alias("actual"), text(message).alias("message"),
    )


def spark_type(target) -> str:
    """The Spark type a target decodes to."""
    if isinstance(target, Newtype):
        return spark_type(target.inner)
    if isinstance(target, Custom):
        return target.spark_type
    if isinstance(target, DecimalOf):
        return f"decimal(38,{target.scale})"
    if isinstance(target, (ListOf, SetOf)):
        return f"array<{spark_type(target.item)}>"
    if isinstance(target, MapOf):
        return f"map<string,{spark_type(target.item)}>"
    if isinstance(target, RecordSpec):
        inner = ",".join(f"`{f.name}`:{spark_type(f.type)}" for f in target.fields if not f.skip_read)
        return f"struct<{inner}>"
    named = {
        "string": "string", "char": "string", "bool": "boolean", "f32": "float", "f64": "double",
        "datetime": "timestamp", "date": "date", "bytes": "binary",
        "link": "struct<bucket:int,pos:bigint>", "dynamic": "variant",
    }
    return INT_TARGETS[target.name][2] if target.name in INT_TARGETS else named[target.name]


# A target is read in two steps so that nothing is written out twice: ``work`` takes the value (or
# the decoded parts of a container), ``finish`` turns it into the value and its error. Table-level
# jobs put the steps in successive projections; inside lists and maps ``let`` binds them.


def work(v: Column, kind: Column, shape: Column, target, json_source: bool) -> Column:
    if isinstance(target, Newtype):
        return work(v, kind, shape, target.inner, json_source)
    if isinstance(target, Custom):
        return target.convert(v).cast(target.spark_type)
    if isinstance(target, DecimalOf):
        # Decimals and int64 (not int32). In JSON every real literal is an exact decimal.
        accepted = shape.startswith("DECIMAL") | (kind == "int64")
        exact = F.when(accepted, _get(v, "decimal(38,18)"))
        value = F.when(accepted, _get(v, f"decimal(38,{target.scale})"))
        return F.when(value.cast("decimal(38,18)") == exact, value)
    if isinstance(target, (ListOf, SetOf)):
        items = F.when(kind == "list", _get(v, "array<variant>"))
        label = "set" if isinstance(target, SetOf) else "list"
        one_by_one = F.transform(items, lambda x, i: read_value(
            x, target.item, F.concat(F.lit(f"{label}["), i.cast("string"), F.lit("]")), json_source))
        whole = _uniform_list(v, shape, target.item)
        if whole is None:
            return one_by_one
        no_error = F.lit(None).cast(ERROR_TYPE)
        good = F.transform(whole, lambda x: F.struct(x.alias("value"), no_error.alias("error")))
        return F.coalesce(good, one_by_one)
    if isinstance(target, MapOf):
        entries = F.map_entries(F.when(kind == "map", v.try_cast("map<string,variant>")))
        return F.transform(entries, lambda e: F.struct(
            e["key"].alias("key"),
            read_value(e["value"], target.item, F.concat(F.lit("map["), e["key"], F.lit("]")), json_source).alias("read")))
    if isinstance(target, RecordSpec):
        props = F.when(kind == "map", v.try_cast("map<string,variant>"))
        fields = [f for f in target.fields if not f.skip_read]
        return let(props, lambda p: F.when(p.isNotNull(), F.struct(
            *[read_field(p, f, target.wire(f), json_source).alias(f.name) for f in fields])))
    return _scalar_work(v, kind, shape, target.name)


def _uniform_list(v: Column, shape: Column, item) -> Column | None:
    """The whole list in one read when all its items have the kind asked for and none is null."""
    name = item.name if isinstance(item, Scalar) else None

    def full(items: Column) -> Column:
        return F.when(F.size(F.array_compact(items)) == F.size(items), items)

    if name == "string":
        return full(F.when(shape == "ARRAY<STRING>", _get(v, "array<string>")))
    if name in INT_TARGETS:
        low, high, type_name = INT_TARGETS[name]
        numbers = F.when(shape == "ARRAY<BIGINT>", _get(v, "array<bigint>"))
        inside = (F.array_min(numbers) >= low) & (F.array_max(numbers) <= high)
        return full(F.when(inside, numbers).try_cast(f"array<{type_name}>"))
    if name in ("f32", "f64"):
        numbers = full(F.when(shape.isin("ARRAY<BIGINT>", "ARRAY<DOUBLE>"), _get(v, "array<double>")))
        return numbers.cast("array<float>") if name == "f32" else numbers
    return None


def finish(w: Column, kind: Column, target, path: Column) -> tuple[Column, Column]:
    """(value, error) from the work column; ``path`` names where the value sits."""

    def below(inner: Column) -> Column:
        return inner.withField("path", F.concat_ws(".", path, F.when(inner["path"] != "", inner["path"])))

    if isinstance(target, Newtype):
        return finish(w, kind, target.inner, path)
    if isinstance(target, Custom):
        return w, F.when(w.isNull(), error(path, "conversion", message="custom conversion failed"))
    if isinstance(target, DecimalOf):
        lossy = error(path, "conversion", message="no exact decimal of this width")
        readable = kind.isin("decimal", "double", "int64")
        return w, F.when(w.isNull(), F.when(readable, lossy).otherwise(error(path, "type_mismatch", "decimal", kind)))
    if isinstance(target, (ListOf, SetOf)):
        bad = F.get(F.filter(w, lambda d: d["error"].isNotNull()), F.lit(0))["error"]
        value = F.transform(w, lambda d: d["value"])
        value = F.array_distinct(value) if isinstance(target, SetOf) else value
        return value, F.when(w.isNull(), error(path, "type_mismatch", "list", kind)).otherwise(let(bad, below))
    if isinstance(target, MapOf):
        bad = F.get(F.filter(w, lambda d: d["read"]["error"].isNotNull()), F.lit(0))["read"]["error"]
        value = F.map_from_entries(F.transform(w, lambda d: F.struct(d["key"].alias("key"), d["read"]["value"].alias("value"))))
        return value, F.when(w.isNull(), error(path, "type_mismatch", "map", kind)).otherwise(let(bad, below))
    if isinstance(target, RecordSpec):
        names = [f.name for f in target.fields if not f.skip_read]
        value = F.when(w.isNotNull(), F.struct(*[w[n]["value"].alias(n) for n in names]))
        bad = F.coalesce(*[w[n]["error"] for n in names])
        return value, F.when(w.isNull(), error(path, "type_mismatch", "record", kind)).otherwise(let(bad, below))
    return w, _scalar_error(w, kind, target.name, path)


def read_value(v: Column, target, path: Column, json_source: bool) -> Column:
    """STRUCT<value, error> of a present VARIANT, as one expression."""

    def with_kind(x, shape, kind):
        def done(w):
            value, err = finish(w, kind, target, path)
            return F.struct(value.alias("value"), err.cast(ERROR_TYPE).alias("error"))

        return let(work(x, kind, shape, target, json_source), done)

    return let(v, lambda x: let(F.schema_of_variant(x), lambda s: let(kind_from(s, x, json_source), lambda k: with_kind(x, s, k))))


def read_field(props: Column, field: FieldSpec, wire: str, json_source: bool) -> Column:
    """STRUCT<value, error> of one field of a property map, with its absent/null/default rules."""
    path = F.lit(wire)

    def one(v):
        return let(read_value(v, field.type, path, json_source), lambda r: F.struct(
            *[c.alias(n) for c, n in zip(field_rules(field, r["value"], r["error"], v.isNull(), F.is_variant_null(v), path), ("value", "error"))]))

    return let(F.try_element_at(props, path), one)


def field_rules(field: FieldSpec, value: Column, err: Column, absent: Column, is_null: Column, path: Column) -> tuple[Column, Column]:
    """Apply required, optional and default to a read value."""
    dtype = spark_type(field.type)
    value = value.cast(dtype) if not isinstance(field.type, RecordSpec) and dtype != "variant" else value
    err = err.cast(ERROR_TYPE)
    if field.optional:
        given = ~absent & ~F.coalesce(is_null, F.lit(False))
        return F.when(given, value), F.when(given, err)
    if field.default is not None:
        default = field.default if isinstance(field.default, Column) else F.lit(field.default)
        return F.when(absent, default.cast(dtype)).otherwise(value), F.when(~absent, err)
    return F.when(~absent, value), F.when(absent, error(path, "missing_field").cast(ERROR_TYPE)).otherwise(err)


def _get(v: Column, type_name: str) -> Column:
    return F.try_variant_get(v, "$", type_name)


def _scalar_work(v: Column, kind: Column, shape: Column, name: str) -> Column:
    if name == "dynamic":
        return v
    if name in ("string", "char"):
        text = F.when(kind == "string", _get(v, "string"))
        if name == "char":
            return F.when(F.char_length(text) == 1, text)
        scale = F.regexp_extract(shape, r",(\d+)\)$", 1).try_cast("int")
        as_text = F.when((kind == "decimal") & (scale > 0), decimal_text(_get(v, "string"), scale))
        return F.coalesce(text, F.when(kind == "timestamp", rfc3339(_get(v, "timestamp"))), as_text)
    if name == "bool":
        return F.when(kind == "bool", _get(v, "boolean"))
    if name in INT_TARGETS:
        low, high, type_name = INT_TARGETS[name]
        scale0 = (kind == "decimal") & shape.endswith(",0)")
        number = F.when(kind.isin("int32", "int64") | scale0, _get(v, "bigint"))
        return F.when(number.between(low, high), number).try_cast(type_name)
    if name in ("f32", "f64"):
        number = F.when(kind.isin("float", "double", "int32", "int64"), _get(v, "double"))
        return number.cast("float") if name == "f32" else number
    if name == "datetime":
        text = F.when(kind == "string", _get(v, "string"))
        return F.coalesce(F.when(kind == "timestamp", _get(v, "timestamp")),
                          F.when(text.rlike(RFC3339), F.try_to_timestamp(F.upper(text))))
    if name == "date":
        return F.when(kind == "timestamp", F.to_date(_get(v, "timestamp")))
    if name == "bytes":
        items = F.when(kind == "list", _get(v, "array<variant>"))
        whole = F.transform(items, lambda x: F.when(F.schema_of_variant(x) == "BIGINT", _get(x, "bigint")))
        return F.coalesce(F.when(kind == "bytes", _get(v, "binary")),
                          ints_to_bytes(F.transform(whole, lambda n: F.coalesce(n, F.lit(-1)))))
    if name == "link":
        return parse_link(F.when(kind == "string", _get(v, "string")))
    raise ValueError(f"unknown target {name!r}")


def _scalar_error(w: Column, kind: Column, name: str, path: Column) -> Column:
    if name == "dynamic":
        return F.lit(None).cast(ERROR_TYPE)
    expected = {"char": "single-char string", "datetime": "timestamp"}.get(name, name)
    wrong = error(path, "type_mismatch", expected, kind)
    if name in ("datetime", "link"):
        wrong = F.when(kind == "string", error(path, "conversion", message=f"invalid {expected} text")).otherwise(wrong)
    if name == "bytes":
        wrong = F.when(kind == "list", error(path, "type_mismatch", "u8", "list item")).otherwise(wrong)
    return F.when(w.isNull(), wrong)
