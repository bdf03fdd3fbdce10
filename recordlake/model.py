"""Declared shapes: field and record specs, types with hierarchy, constraints, indexes, series."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

# Intrinsic columns every record, and every edge, carries. Never schema-managed.
INTRINSICS = ("@rid", "@type", "@in", "@out")


# ---- value types a reader can ask for -------------------------------------------------------


@dataclass(frozen=True)
class Scalar:
    """string, char, bool, i8..i64, u8..u64, f32, f64, datetime, date, bytes, link or dynamic."""

    name: str


@dataclass(frozen=True)
class DecimalOf:
    scale: int = 0


@dataclass(frozen=True)
class ListOf:
    item: Any


@dataclass(frozen=True)
class SetOf:
    item: Any


@dataclass(frozen=True)
class MapOf:
    item: Any


@dataclass(frozen=True)
class Newtype:
    """A one-field wrapper; reads exactly like what it wraps."""

    inner: Any


@dataclass(frozen=True)
class Custom:
    """A conversion supplied by the caller.

    ``convert`` maps the VARIANT column to a column of ``spark_type``; a null result for a
    non-null input is reported as a conversion error.
    """

    convert: Callable
    spark_type: str


@dataclass(frozen=True)
class FieldSpec:
    """One field of a record class.

    ``required`` fields must be present; an ``optional`` field reads absent and null as null; a
    field with ``default`` takes it only when the property is absent, so an explicit null is then a
    decode error.
    """

    name: str
    type: Any = Scalar("string")
    optional: bool = False
    default: Any = None
    read_as: str | None = None
    write_as: str | None = None
    skip_read: bool = False
    skip_write: bool = False
    skip_write_if: Callable | None = None
    flatten: bool = False
    key: bool = False


@dataclass(frozen=True)
class RecordSpec:
    """A record class: ordered fields, a case style for their wire names, an optional tag."""

    name: str
    fields: tuple[FieldSpec, ...]
    rename_all: str | None = None

    def wire(self, spec_field: FieldSpec, side: str = "read") -> str:
        from recordlake.functions.names import field_name

        explicit = spec_field.read_as if side == "read" else spec_field.write_as
        if explicit:
            return explicit
        return field_name(spec_field.name, self.rename_all) if self.rename_all else spec_field.name

    @property
    def key_columns(self) -> list[str]:
        return [self.wire(f, "write") for f in self.fields if f.key]

    def wires(self) -> list[str]:
        """Names this class reads, in declaration order; flattened targets describe their own."""
        return [self.wire(f) for f in self.fields if not f.skip_read and not f.flatten]


# ---- types, constraints, indexes ------------------------------------------------------------


@dataclass(frozen=True)
class Constraints:
    mandatory: bool = False
    not_null: bool = False
    readonly: bool = False
    external: bool = False
    min: str | None = None
    max: str | None = None
    regexp: str | None = None
    default: str | None = None


@dataclass(frozen=True)
class Property:
    name: str
    type_name: str = "STRING"
    constraints: Constraints = Constraints()


@dataclass(frozen=True)
class Index:
    columns: tuple[str, ...]
    kind: str = "NOTUNIQUE"
    name: str | None = None

    @property
    def unique(self) -> bool:
        return self.kind == "UNIQUE"


@dataclass(frozen=True)
class TimeseriesSpec:
    timestamp: str
    tags: tuple[str, ...] = ()
    fields: tuple[str, ...] = ()
    precision: str | None = None
    shards: int | None = None
    retention: str | None = None
    compaction: str | None = None


@dataclass(frozen=True)
class TypeSpec:
    """A document, vertex, edge or time-series type."""

    name: str
    kind: str = "DOCUMENT"
    extends: tuple[str, ...] = ()
    properties: tuple[Property, ...] = ()
    indexes: tuple[Index, ...] = ()
    series: TimeseriesSpec | None = None

    def prop(self, name: str) -> Property | None:
        return next((p for p in self.properties if p.name == name), None)


@dataclass
class TypeSet:
    """Type specs by name plus the table behind each concrete type."""

    specs: dict[str, TypeSpec] = field(default_factory=dict)
    tables: dict[str, Any] = field(default_factory=dict)

    def add(self, spec: TypeSpec, table=None) -> "TypeSet":
        self.specs[spec.name] = spec
        if table is not None:
            self.tables[spec.name] = table
        return self

    def closure(self, name: str) -> list[str]:
        """The type and everything that extends it, directly or not."""
        if name not in self.specs:
            raise KeyError(f"unknown type {name}")
        found, queue = [name], [name]
        while queue:
            parent = queue.pop(0)
            for spec in self.specs.values():
                if parent in spec.extends and spec.name not in found:
                    found.append(spec.name)
                    queue.append(spec.name)
        return found


def quoted(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]
