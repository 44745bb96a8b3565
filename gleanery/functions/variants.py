"""Reading loosely typed JSON with the variant type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.scalars import let


def at(v: Column, path: str, kind: str = "variant") -> Column:
    """Value at a path, NULL when absent or of another kind."""
    return F.try_variant_get(v, path, kind)


def text_at(v: Column, *paths: str) -> Column:
    """First non-empty text among several paths."""
    return F.coalesce(*[let(at(v, p, "string"), lambda x: F.nullif(x, F.lit(""))) for p in paths])


def number_at(v: Column, *paths: str) -> Column:
    """First whole number other than 0 among several paths."""
    return F.coalesce(*[let(at(v, p, "bigint"), lambda x: F.nullif(x, F.lit(0))) for p in paths])


def truthy(v: Column) -> Column:
    """Neither absent, null, false nor 0. Arrays and objects count as present even when empty."""
    return v.isNotNull() & ~F.is_variant_null(v) & F.coalesce(as_kind(v, "boolean"), F.lit(True))


def first_truthy(*options: Column) -> Column:
    return F.coalesce(*[let(o, lambda v: F.when(truthy(v), v)) for o in options])


def first_at(v: Column, *paths: str) -> Column:
    """First truthy value among several paths of one variant."""
    return first_truthy(*[at(v, p) for p in paths])


def as_kind(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)
