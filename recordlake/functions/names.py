"""The eight case styles, for column names (Python) and for variant values (columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted style names.
STYLES = (
    "lowercase", "UPPERCASE", "PascalCase", "camelCase",
    "snake_case", "SCREAMING_SNAKE_CASE", "kebab-case", "SCREAMING-KEBAB-CASE",
)


def _check(style: str) -> None:
    if style not in STYLES:
        raise ValueError(f"unknown case style {style!r}")


def field_name(name: str, style: str) -> str:
    """A snake_case field name in the given style; lowercase and snake_case leave it alone."""
    _check(style)
    words = [w[:1].upper() + w[1:] for w in name.split("_")]
    pascal = "".join(words)
    shaped = {
        "UPPERCASE": name.upper(),
        "SCREAMING_SNAKE_CASE": name.upper(),
        "PascalCase": pascal,
        "camelCase": pascal[:1].lower() + pascal[1:],
        "kebab-case": name.replace("_", "-"),
        "SCREAMING-KEBAB-CASE": name.upper().replace("_", "-"),
    }
    return shaped.get(style, name)


def variant_value(value: Column, style: str) -> Column:
    """A PascalCase variant value in the given style; every capital starts a word (no acronyms)."""
    _check(style)
    snake = F.lower(F.regexp_replace(value, r"(?<!^)(\p{Lu})", "_$1"))
    if style == "PascalCase":
        return value
    if style == "lowercase":
        return F.lower(value)
    if style == "UPPERCASE":
        return F.upper(value)
    if style == "camelCase":
        return F.concat(F.lower(F.substring(value, 1, 1)), F.substring(value, F.lit(2), F.length(value)))
    if style == "snake_case":
        return snake
    if style == "SCREAMING_SNAKE_CASE":
        return F.upper(snake)
    if style == "kebab-case":
        return F.replace(snake, F.lit("_"), F.lit("-"))
    return F.upper(F.replace(snake, F.lit("_"), F.lit("-")))
