"""Projections and record shaping."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.functions.names import field_name
from recordlake.model import RecordSpec
from recordlake.operators.skew import join_to_one


def select_wires(df: DataFrame, spec: RecordSpec) -> DataFrame:
    """Exactly the columns a record class reads, in declaration order."""
    names = spec.wires()
    for field in spec.fields:
        if field.flatten and isinstance(field.type, RecordSpec):
            names += field.type.wires()
    return df.select(*[F.col(f"`{n}`") for n in names])


def rename_all(df: DataFrame, style: str) -> DataFrame:
    return df.withColumnsRenamed({c: field_name(c, style) for c in df.columns})


def read_names(df: DataFrame, spec: RecordSpec) -> DataFrame:
    """Stored names to field names."""
    return df.select(*[F.col(f"`{spec.wire(f)}`").alias(f.name) for f in spec.fields if not f.skip_read])


def write_names(df: DataFrame, spec: RecordSpec) -> DataFrame:
    """Field names to stored names, dropping fields skipped on write."""
    return df.select(*[F.col(f.name).alias(spec.wire(f, "write")) for f in spec.fields if not f.skip_write])


def flatten_rest(df: DataFrame, taken: Sequence[str], column: str = "properties", rest: str = "rest") -> DataFrame:
    """The part of a property map the parent did not take."""
    return df.withColumn(rest, F.map_filter(F.col(column), lambda k, v: ~k.isin(list(taken))))


def flatten_struct(df: DataFrame, column: str, taken: Sequence[str] = ()) -> DataFrame:
    """A nested struct's fields beside the parent's own; parent names hide nested ones."""
    inner = [f.name for f in df.schema[column].dataType.fields if f.name not in taken]
    return df.select(*[c for c in df.columns if c != column], *[F.col(f"{column}.{c}") for c in inner])


def with_default(props: Column, key: str, default: Column) -> Column:
    """The property, or the default only when the key is absent: an explicit null stays null."""
    present = F.coalesce(F.map_contains_key(props, key), F.lit(False))
    return F.when(present, F.try_element_at(props, F.lit(key))).otherwise(default)


def skip_if(df: DataFrame, column: str, test: Callable[[Column], Column]) -> DataFrame:
    """Null a column where the predicate holds, so encoding leaves it out."""
    return df.withColumn(column, F.when(~F.coalesce(test(F.col(column)), F.lit(False)), F.col(column)))


def intrinsics(records: DataFrame, column: str = "properties") -> DataFrame:
    """``@rid``/``@type`` from the properties when present, else the record's own metadata."""

    def pick(key: str, own: str) -> Column:
        stored = F.try_element_at(F.col(column), F.lit(key)).cast("string")
        return F.coalesce(stored, F.col(own)).alias(key)

    return records.select("*", pick("@rid", "rid"), pick("@type", "type"))


def dispatch(df: DataFrame, tag: str, variants: dict[str, Sequence[str]]) -> DataFrame:
    """A tagged union: the tag picks the variant, whose columns fill one struct per variant.

    ``code`` is missing_field for a null tag, unknown_variant for one not listed, else null.
    """
    value = F.col(tag)
    structs = [
        F.when(value == name, F.struct(*[F.col(c) for c in columns])).alias(name) for name, columns in variants.items()
    ]
    code = F.when(value.isNull(), F.lit("missing_field")).when(~value.isin(list(variants)), F.lit("unknown_variant"))
    return df.select("*", *structs, code.alias("code"))


def enum_decode(df: DataFrame, column: str, variants: dict[str, str], name: str = "variant") -> DataFrame:
    """A closed list of texts to variant names; anything else gives null and code unknown_variant."""
    out = F.lit(None).cast("string")
    for text, variant in variants.items():
        out = F.when(F.col(column) == text, F.lit(variant)).otherwise(out)
    return df.withColumn(name, out).withColumn(
        "code",
        F.when(F.col(column).isNull(), F.lit("missing_field")).when(F.col(name).isNull(), F.lit("unknown_variant")),
    )


def encode_links(df: DataFrame, link: str, target: DataFrame | None = None, key: str = "rid", encoding: str = "LINK") -> DataFrame:
    """A link column as it appears in results: the link itself, the record (MAP), or its JSON text."""
    if encoding == "LINK":
        return df
    body = [c for c in target.columns if c != key]
    lookup = target.select(F.col(key).alias(link), F.struct(F.col(key), *body).alias("_record"))
    joined = join_to_one(df, lookup, [link], "left")
    record = F.col("_record") if encoding == "MAP" else F.to_json("_record")
    if encoding not in ("MAP", "JSON"):
        raise ValueError(f"unknown link encoding {encoding!r}")
    return joined.withColumn(link, record).drop("_record")


def soft_limit(batches: DataFrame, batch: str, order: str, limit: int, size: Column) -> DataFrame:
    """Cut each batch into parts at the soft limit: ``part_no`` from 0, every row in one part.

    A part ends with the row that takes the running size to the next multiple of the limit, so only its
    last row may reach beyond. Meant for numbered batches of a fixed row count, so a batch is always
    one small window.
    """
    running = Window.partitionBy(batch).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(size).over(running), F.lit(0))
    return batches.withColumn("part_no", F.floor(before / F.lit(limit)).cast("bigint"))
