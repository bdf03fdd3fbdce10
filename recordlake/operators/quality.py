"""Constraint, uniqueness, link and reader-drift checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.model import Property, TypeSpec
from recordlake.operators.change import snapshot_diff
from recordlake.operators.skew import join_to_one


def _bound(column: Column, data_type: T.DataType, limit: str) -> tuple[Column, Column]:
    """What a MIN/MAX compares: the value, a text's length, or a collection's size."""
    if isinstance(data_type, T.StringType):
        return F.char_length(column), F.lit(int(limit))
    if isinstance(data_type, (T.ArrayType, T.MapType)):
        return F.size(column), F.lit(int(limit))
    return column, F.lit(limit).cast(data_type)


def _dynamic_bound(raw: Column, dtype: T.DataType, declared: str, limit: str, beyond) -> Column:
    """A MIN/MAX on a value whose kind is known per row only. Declared numbers compare by value, texts that
    spell one included; otherwise texts compare by length and collections by size. A limit that is no
    number is a time; texts are then read as times."""
    try:
        number = float(limit)
    except ValueError:
        number = None
    variant = dtype.simpleString() == "variant"
    text = F.try_variant_get(raw, "$", "string") if variant else raw.cast("string")
    if number is None:
        return beyond(F.try_to_timestamp(text), F.lit(limit).cast("timestamp"))
    if not variant:
        return beyond(raw, F.lit(number)) if isinstance(dtype, T.NumericType) else beyond(
            F.coalesce(text.try_cast("double"), F.char_length(text).cast("double")), F.lit(number))
    if TYPE_CLASSES.get(declared.upper()) in ("int", "float"):
        return beyond(F.try_variant_get(raw, "$", "double"), F.lit(number))
    kind = F.schema_of_variant(raw)
    size = (
        F.when(kind == "STRING", F.char_length(text))
        .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(raw, "$", "array<variant>")))
        .when(kind.startswith("OBJECT"), F.size(F.try_variant_get(raw, "$", "map<string,variant>")))
    )
    return beyond(F.coalesce(size.cast("double"), F.try_variant_get(raw, "$", "double")), F.lit(number))


def constraint_rules(prop: Property, schema: T.StructType, props: str | None = None) -> list[tuple[str, Column]]:
    """(rule, violated) pairs of one property.

    With ``props`` the property lives in that map column, so MANDATORY means the key is present;
    for fixed columns it means the column exists.
    """
    c = prop.constraints
    rules: list[tuple[str, Column]] = []
    if props:
        raw = F.try_element_at(F.col(props), F.lit(prop.name))
        if c.mandatory:
            rules.append(("mandatory", ~F.coalesce(F.map_contains_key(F.col(props), prop.name), F.lit(False))))
        if c.not_null:
            null_value = raw.isNull() & F.map_contains_key(F.col(props), prop.name)
            if schema[props].dataType.valueType.simpleString() == "variant":
                null_value = F.is_variant_null(raw)
            rules.append(("notnull", F.coalesce(null_value, F.lit(False))))
        dtype = schema[props].dataType.valueType
        text = raw if dtype.simpleString() != "variant" else F.try_variant_get(raw, "$", "string")
        if c.min is not None:
            rules.append(("min", _dynamic_bound(raw, dtype, prop.type_name or "", c.min, lambda a, b: a < b)))
        if c.max is not None:
            rules.append(("max", _dynamic_bound(raw, dtype, prop.type_name or "", c.max, lambda a, b: a > b)))
        if c.regexp is not None:
            rules.append(("regexp", ~text.rlike(rf"\A(?:{c.regexp})\z")))
        return rules
    if prop.name not in schema.names:
        return [("mandatory", F.lit(True))] if c.mandatory else []
    column, dtype = F.col(f"`{prop.name}`"), schema[prop.name].dataType
    if c.not_null:
        rules.append(("notnull", column.isNull()))
    if c.min is not None:
        value, limit = _bound(column, dtype, c.min)
        rules.append(("min", value < limit))
    if c.max is not None:
        value, limit = _bound(column, dtype, c.max)
        rules.append(("max", value > limit))
    if c.regexp is not None:
        rules.append(("regexp", ~column.cast("string").rlike(rf"\A(?:{c.regexp})\z")))
    return rules


def check_constraints(df: DataFrame, spec: TypeSpec, keys: Sequence[str], props: str | None = None) -> DataFrame:
    """Violations in long form: keys, property, rule, value. One scan, no shuffle."""
    found = []
    for prop in spec.properties:
        if props:
            raw = F.try_element_at(F.col(props), F.lit(prop.name))
            dynamic = df.schema[props].dataType.valueType.simpleString() == "variant"
            value = F.try_variant_get(raw, "$", "string") if dynamic else raw.cast("string")
        else:
            value = F.col(f"`{prop.name}`").cast("string") if prop.name in df.columns else F.lit(None).cast("string")
        for rule, violated in constraint_rules(prop, df.schema, props):
            row = F.struct(F.lit(prop.name).alias("property"), F.lit(rule).alias("rule"), value.alias("value"))
            found.append(F.when(violated, row))
    if not found:
        raise ValueError(f"type {spec.name} declares no checkable constraint")
    return df.select(*keys, F.explode(F.array_compact(F.array(*found))).alias("_violation")).select(*keys, "_violation.*")


def check_readonly(old: DataFrame, new: DataFrame, keys: Sequence[str], spec: TypeSpec) -> DataFrame:
    """Read-only properties that changed between two snapshots, one row per key and property."""
    locked = [p.name for p in spec.properties if p.constraints.readonly and p.name in new.columns]
    diff = snapshot_diff(old.select(*keys, *locked), new.select(*keys, *locked), keys)
    return diff.select(*keys, F.explode("changed").alias("property"))


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of a unique index held by more than one row. Null members are not compared."""
    full = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    return df.where(full).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_links(df: DataFrame, column: str, target: DataFrame, key: str = "rid") -> DataFrame:
    """Rows whose link points at no record of the target. Null links are not checked."""
    known = target.select(F.col(key).alias(column)).distinct()
    return join_to_one(df.where(F.col(column).isNotNull()), known, [column], "left_anti")


def apply_defaults(df: DataFrame, spec: TypeSpec, props: str | None = None) -> DataFrame:
    """Declared defaults (literal or expression text) where a property is absent.

    In a property map an explicit null is present and stays; a fixed column that is null is absent.
    """
    for prop in spec.properties:
        if prop.constraints.default is None:
            continue
        value = F.expr(prop.constraints.default)
        if props:
            dtype = df.schema[props].dataType.valueType
            absent = ~F.coalesce(F.map_contains_key(F.col(props), prop.name), F.lit(False))
            added = F.create_map(F.lit(prop.name), value.cast(dtype))
            empty = F.create_map().cast(df.schema[props].dataType)
            df = df.withColumn(props, F.when(absent, F.map_concat(F.coalesce(F.col(props), empty), added)).otherwise(F.col(props)))
        elif prop.name in df.columns:
            df = df.withColumn(prop.name, F.coalesce(F.col(prop.name), value.cast(df.schema[prop.name].dataType)))
        else:
            df = df.withColumn(prop.name, value)
    return df


# ---- reader drift ---------------------------------------------------------------------------

# Column type names and their class. Names not listed are unknown, hence compatible.
TYPE_CLASSES = {
    "STRING": "str", "STRINGS": "str", "LINK": "str",
    "BOOLEAN": "bool", "BOOLEANS": "bool",
    "INTEGER": "int", "INTEGERS": "int", "LONG": "int", "LONGS": "int", "SHORT": "int", "BYTE": "int",
    "FLOAT": "float", "FLOATS": "float", "DOUBLE": "float", "DOUBLES": "float",
    "DATETIME": "datetime", "DATE": "datetime",
    "MAP": "map", "EMBEDDEDMAP": "map",
}
# Fixed values: (reader class, stored class) pairs that decode, besides equal classes.
EXTRA_READS = (("float", "int"), ("datetime", "str"), ("str", "datetime"))
# Element classes a list may have; any other list is unknown.
LIST_ELEMENTS = ("str", "bool", "int", "float")


def type_class(type_name: Column) -> Column:
    """Class of a column type name; list forms give ``list:<class>``, the rest ``unknown``."""
    text = F.upper(F.trim(type_name))
    collection = r"^(?:LIST OF |SET OF |ARRAY_OF_*|SET_OF_*)(.*)$"
    element = F.regexp_extract(text, collection, 1)
    is_list = text.rlike(collection)
    lookup = F.create_map(*[F.lit(x) for pair in TYPE_CLASSES.items() for x in pair])
    scalar = F.coalesce(F.try_element_at(lookup, F.when(is_list, element).otherwise(text)), F.lit("unknown"))
    return F.when(~is_list, scalar).when(scalar.isin(*LIST_ELEMENTS), F.concat(F.lit("list:"), scalar)).otherwise(F.lit("unknown"))


def reads_as(expected: Column, actual: Column) -> Column:
    """Whether a reader of ``expected`` can decode a column stored as ``actual``."""
    want, have = type_class(expected), type_class(actual)
    extra = [(want == a) & (have == b) for a, b in EXTRA_READS] + [(want == "list:float") & (have == "list:int")]
    return reduce(Column.__or__, extra, (want == "unknown") | (have == "unknown") | (want == have))


def missing_columns(needed: DataFrame, actual: DataFrame) -> DataFrame:
    """Needed (type, property) rows the columns table lacks. ``@`` names are exempt."""
    asked = needed.where(~F.col("property").startswith("@"))
    return join_to_one(asked, actual.select("type", "property").distinct(), ["type", "property"], "left_anti")


def type_drift(needed: DataFrame, actual: DataFrame) -> DataFrame:
    """Needed columns stored in a type the reader cannot decode."""
    want = needed.select("type", "property", F.col("type_name").alias("expected"))
    have = actual.select("type", "property", F.col("type_name").alias("actual"))
    return want.join(have, ["type", "property"]).where(~reads_as(F.col("expected"), F.col("actual")))

