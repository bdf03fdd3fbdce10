"""Table jobs for dynamic records: typed decode with quarantine, and encode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.decoding import field_rules, finish, work
from recordlake.functions.values import json_ready, kind_from
from recordlake.model import FieldSpec, RecordSpec


def _planned(spec: RecordSpec) -> list[tuple[FieldSpec, str, tuple[str, ...] | None]]:
    """(field, wire name, names hidden from it) for every field read, flattened targets unfolded."""
    taken = tuple(spec.wire(f) for f in spec.fields if not f.skip_read and not f.flatten)
    out = []
    for field in spec.fields:
        if field.skip_read:
            continue
        if field.flatten and isinstance(field.type, RecordSpec):
            out += [(f, field.type.wire(f), taken) for f in field.type.fields if not f.skip_read]
        elif not field.flatten:
            out.append((field, spec.wire(field), None))
    return out


def decode_columns(records: DataFrame, spec: RecordSpec, json_source: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``rid``, ``type``, the decoded fields and ``errors``: the first error of each bad field.

    Takes ``rid``, ``type`` and a ``properties`` map. Fields named ``@rid``/``@type`` read the
    property when present, else the record's own. Successive projections take the value, its kind,
    the typed value and the error, so each is computed once; all of them run in one narrow stage.
    """
    own = {"@rid": F.col("rid"), "@type": F.col("type")}
    planned = _planned(spec)
    rest = [f for f in spec.fields if f.flatten and not isinstance(f.type, RecordSpec)]
    taken = [wire for _, wire, _ in planned]

    def raw(wire: str, hidden) -> Column:
        if hidden and wire in hidden:
            return F.lit(None).cast("variant")
        value = F.try_element_at(F.col("properties"), F.lit(wire))
        return F.coalesce(value, own[wire].cast("variant")) if wire in own else value

    names = {f.name for f, _, _ in planned} | {f.name for f in rest}
    meta = [c for c in ("rid", "type", *keep) if c not in names]
    lead = [F.col(c).alias(f"_m_{c}") for c in meta] + [
        F.map_filter("properties", lambda k, v: ~k.isin(taken)).alias(f"_r_{f.name}") for f in rest]
    number = range(len(planned))
    out = records.select(*lead, *[raw(w, h).alias(f"_v{i}") for i, (_, w, h) in enumerate(planned)])
    out = out.select("*", *[F.schema_of_variant(f"_v{i}").alias(f"_s{i}") for i in number])
    out = out.select("*", *[kind_from(F.col(f"_s{i}"), F.col(f"_v{i}"), json_source).alias(f"_k{i}") for i in number])
    out = out.select("*", *[
        work(F.col(f"_v{i}"), F.col(f"_k{i}"), F.col(f"_s{i}"), f.type, json_source).alias(f"_w{i}")
        for i, (f, _, _) in enumerate(planned)])
    # A filter on the errors must not be pushed below this point, where it would repeat all of the
    # work above inside its condition; a generated row stops it.
    out = out.select(F.explode(F.array(F.struct("*"))).alias("_row")).select("_row.*")
    fields, errors = [], []
    for i, (field, wire, _) in enumerate(planned):
        kind, path = F.col(f"_k{i}"), F.lit(wire)
        value, err = finish(F.col(f"_w{i}"), kind, field.type, path)
        value, err = field_rules(field, value, err, kind == "absent", kind == "null", path)
        fields.append(value.alias(field.name))
        errors.append(err)
    return out.select(
        *[F.col(f"_m_{c}").alias(c) for c in meta], *fields, *[F.col(f"_r_{f.name}").alias(f.name) for f in rest],
        F.array_compact(F.array(*errors)).alias("errors"))


def decode(records: DataFrame, spec: RecordSpec, mode: str = "quarantine", json_source: bool = True, keep: tuple[str, ...] = ()):
    """Decode records. ``quarantine`` gives (good, bad); ``failfast`` one frame that fails on a bad row.

    ``bad`` has one row per bad field: rid, type, path, code, expected, actual, message.
    """
    out = decode_columns(records, spec, json_source, keep)
    if mode == "failfast":
        first = F.get(F.col("errors"), F.lit(0))
        text = F.concat_ws(" ", first["code"], first["path"], first["expected"], first["actual"], first["message"])
        checked = F.when(F.size("errors") > 0, F.raise_error(text)).otherwise(F.lit(True))
        return out.withColumn("_ok", checked).where(F.col("_ok").cast("boolean")).drop("errors", "_ok")
    if mode != "quarantine":
        raise ValueError(f"unknown decode mode {mode!r}")
    return split_errors(out, keep)


def split_errors(out: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Decoded columns as (good, bad)."""
    good = out.where(F.size("errors") == 0).drop("errors")
    meta = [c for c in ("rid", "type", *keep) if c in out.columns]
    bad = out.where(F.size("errors") > 0).select(*meta, F.explode("errors").alias("e")).select(*meta, "e.*")
    return good, bad


# The stored width of each narrow integer type.
WIDEN = {"tinyint": "int", "smallint": "int"}


def encode_fields(df: DataFrame, spec: RecordSpec) -> list[tuple[str, Column]]:
    """(wire name, column) for every written field, widths applied, skip-if values nulled."""
    out = []
    for field in spec.fields:
        if field.skip_write:
            continue
        column = F.col(field.name)
        dtype = df.schema[field.name].dataType.simpleString()
        if dtype in WIDEN:
            column = column.cast(WIDEN[dtype])
        if field.skip_write_if is not None:
            column = F.when(~F.coalesce(field.skip_write_if(F.col(field.name)), F.lit(False)), column)
        out.append((spec.wire(field, "write"), column))
    return out


def encode(df: DataFrame, spec: RecordSpec, rid: Column | None = None) -> DataFrame:
    """Rows to records: a map of dynamic values, nulls omitted, skip rules applied."""
    pairs = [c for wire, column in encode_fields(df, spec) for c in (F.lit(wire), _variant(df, column, wire))]
    props = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
    return df.select(
        (rid if rid is not None else F.lit(None).cast("string")).alias("rid"),
        F.lit(spec.name).alias("type"), props.alias("properties"),
    )


def _variant(df: DataFrame, column: Column, wire: str) -> Column:
    dtype = df.select(column.alias("c")).schema["c"].dataType.simpleString()
    if dtype.startswith(("struct", "array", "map")):
        return F.when(column.isNotNull(), F.to_variant_object(column))
    return column.cast("variant")


def record_json(records: DataFrame, column: str = "json") -> DataFrame:
    """Record to one JSON object: properties plus ``@rid``/``@type``.

    Empty metadata is left out; where a property has the same name the metadata wins.
    """
    names = {"@rid": "rid", "@type": "type"}
    present = {k: F.coalesce(F.length(F.col(c)) > 0, F.lit(False)) for k, c in names.items()}
    props = F.map_filter(
        F.col("properties"),
        lambda k, v: ~((k == "@rid") & present["@rid"]) & ~((k == "@type") & present["@type"]),
    )
    meta = F.map_filter(
        F.create_map(*[x for k, c in names.items() for x in (F.lit(k), F.col(c).cast("variant"))]),
        lambda k, v: ((k == "@rid") & present["@rid"]) | ((k == "@type") & present["@type"]),
    )
    return records.withColumn(column, F.to_json(F.map_concat(props, meta)))


def rows_json(df: DataFrame, column: str = "json") -> DataFrame:
    """Typed rows to JSON text by the bridge rules; null columns are left out."""
    parts = [json_ready(F.col(f.name), f.dataType.simpleString()).alias(f.name) for f in df.schema.fields]
    return df.withColumn(column, F.to_json(F.struct(*parts)))
