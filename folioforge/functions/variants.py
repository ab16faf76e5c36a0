"""Tolerant access to nested JSON: a section of the wrong kind reads as absent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def parse_object(trimmed: Column) -> Column:
    """Variant of a body that is one JSON object, else null; ``trimmed`` has no white
    space around it."""
    enclosed = trimmed.startswith("{") & trimmed.endswith("}")
    return F.try_parse_json(F.when(enclosed, trimmed))


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def has_key(value: Column, key: str) -> Column:
    """True when the key is there, also with an explicit JSON null."""
    return F.try_variant_get(value, f"$.{key}", "variant").isNotNull()


def text(value: Column, *path: str) -> Column:
    """Scalar at a path as text; null when absent or when a step is not an object."""
    return F.try_variant_get(value, ".".join(("$", *path)), "string")


def items(value: Column, key: str) -> Column:
    """Elements of a list, or null when the key does not hold a list."""
    return F.try_variant_get(value, f"$.{key}", "array<variant>")


def texts(value: Column, key: str, field: str) -> Column:
    """One field of every element; elements that are not objects give null."""
    return F.transform(items(value, key), lambda item: text(item, field))
