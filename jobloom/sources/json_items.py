"""Reading duck-typed JSON: fields that may be scalar, object or list are VARIANT values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from jobloom.functions.arrays import trimmed, trimmed_distinct
from jobloom.functions.text import strip, text_or_blank

_FALSY = ("false", "0", "0.0", "[]", "{}")


def _path(path: str) -> str:
    return "$" + "".join(f"['{key}']" for key in path.split(".")) if path else "$"


def _none() -> Column:
    return F.array().cast("array<string>")


def elements(value: Column) -> Column:
    """``array<variant>`` of a JSON list; empty for anything else."""
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.from_json(F.lit("[]"), "array<variant>"))


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def is_list(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("ARRAY"), F.lit(False))


def as_text(value: Column) -> Column:
    return text_or_blank(F.try_variant_get(value, "$", "string"))


def field(value: Column, path: str) -> Column:
    return F.try_variant_get(value, _path(path), "variant")


def entry_name(value: Column, *keys: str) -> Column:
    """Text of a list entry that is a string or an object naming itself."""
    named = F.coalesce(*[F.nullif(as_text(field(value, k)), F.lit("")) for k in keys], F.lit(""))
    return F.when(is_object(value), named).otherwise(as_text(value))


def names(value: Column, *keys: str, distinct: bool = True) -> Column:
    """Names of a list of strings or objects, trimmed and without blanks."""
    keys = keys or ("name", "title")
    found = F.transform(elements(value), lambda e: entry_name(e, *keys))
    return trimmed_distinct(found) if distinct else trimmed(found)


def values(value: Column) -> Column:
    """A list, or a scalar as a one-element list; trimmed, distinct, without blanks."""
    listed = F.when(is_list(value), F.transform(elements(value), as_text)).otherwise(F.array(as_text(value)))
    return trimmed_distinct(listed)


def metadata_values(value: Column, wanted: Sequence[str]) -> Column:
    """Values of ``[{name, value}]`` entries with one of the wanted names."""
    def one(e: Column) -> Column:
        name = F.lower(F.regexp_replace(strip(as_text(field(e, "name"))), ":+$", ""))
        return F.when(name.isin(*wanted), values(field(e, "value"))).otherwise(_none())

    return F.array_distinct(F.flatten(F.transform(elements(value), one)))


_PLACE_KEYS = ("locationName", "name", "title", "city", "state", "country", "countryName")


def location_text(value: Column) -> Column:
    """Display text of a location given as text, object or list of either."""

    def single(v: Column) -> Column:
        parts = trimmed_distinct(F.array(*[as_text(field(v, k)) for k in _PLACE_KEYS]))
        return F.when(is_object(v), F.array_join(parts, ", ")).otherwise(as_text(v))

    several = F.array_join(F.filter(F.transform(elements(value), single), lambda t: t != ""), " | ")
    return text_or_blank(F.when(is_list(value), several).otherwise(single(value)))


class Item:
    """One payload item with Python-like truthiness for its fields."""

    def __init__(self, value: Column):
        self.value = value

    def raw(self, path: str) -> Column:
        return field(self.value, path)

    def text(self, path: str) -> Column:
        return text_or_blank(F.try_variant_get(self.value, _path(path), "string"))

    def first(self, *paths: str) -> Column:
        """First field that carries something."""
        return F.coalesce(*[F.when(self.truthy(p), self.text(p)) for p in paths], F.lit(""))

    def number(self, path: str) -> Column:
        return F.try_variant_get(self.value, _path(path), "double")

    def truthy(self, path: str) -> Column:
        text = self.text(path)
        is_string = F.coalesce(F.schema_of_variant(self.raw(path)) == "STRING", F.lit(False))
        return (text != "") & (is_string | ~text.isin(*_FALSY))

    def is_true(self, path: str) -> Column:
        """Strictly the JSON value ``true``."""
        return F.coalesce(
            (F.schema_of_variant(self.raw(path)) == "BOOLEAN") & F.try_variant_get(self.value, _path(path), "boolean"), F.lit(False)
        )

    def is_false(self, path: str) -> Column:
        return F.coalesce(
            (F.schema_of_variant(self.raw(path)) == "BOOLEAN") & ~F.try_variant_get(self.value, _path(path), "boolean"), F.lit(False)
        )

    def elements(self, path: str) -> Column:
        return elements(self.raw(path))

    def names(self, path: str, *keys: str, distinct: bool = True) -> Column:
        return names(self.raw(path), *keys, distinct=distinct)

    def values(self, path: str) -> Column:
        return values(self.raw(path))

    def objects(self, path: str) -> Column:
        return F.filter(self.elements(path), is_object)
