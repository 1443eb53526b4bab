"""VARIANT helpers.

Documents are kept as VARIANT (``try_parse_json``): malformed text becomes
NULL instead of failing the job, any key order or type is accepted, and paths
are read without declaring a schema first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_doc(text) -> Column:
    """JSON text -> VARIANT; bad JSON -> NULL."""
    return F.try_parse_json(_c(text))


def vpath(v, path: str) -> Column:
    """Sub-document at ``path`` as VARIANT.  SQL NULL when the path is
    missing; a JSON null stays a VARIANT null (see ``key_present``)."""
    return F.try_variant_get(_c(v), path, "variant")


def vstr(v, path: str = "$") -> Column:
    """String value at path; numbers are rendered as text, objects as JSON."""
    return F.try_variant_get(_c(v), path, "string")


def vlong(v, path: str = "$") -> Column:
    return F.try_variant_get(_c(v), path, "bigint")


def vdouble(v, path: str = "$") -> Column:
    return F.try_variant_get(_c(v), path, "double")


def vbool(v, path: str = "$") -> Column:
    return F.try_variant_get(_c(v), path, "boolean")


def varr(v, path: str = "$") -> Column:
    """Array at path as ARRAY<VARIANT>; NULL when missing, null or not an
    array, so an inner explode yields no rows for it."""
    return F.try_variant_get(_c(v), path, "array<variant>")


def truthy(v) -> Column:
    """Python truthiness of a JSON value.

    False for: missing, null, "", number 0 (any numeric type), false, {}, [].
    True otherwise -- in particular the *string* "0" is true.
    """
    v = _c(v)
    t = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit(False))
        .when(t == "STRING", F.try_variant_get(v, "$", "string") != "")
        .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(t.startswith("OBJECT"), t != "OBJECT<>")
        .when(t.startswith("ARRAY"), F.array_size(F.try_variant_get(v, "$", "array<variant>")) > 0)
        .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != 0, F.lit(True)))
    )


def key_present(doc, key: str) -> Column:
    """True when the top-level ``key`` exists in the object, even with a JSON
    null value."""
    return F.coalesce(
        F.array_contains(top_keys(doc), F.lit(key)), F.lit(False))


def top_keys(doc) -> Column:
    """Top-level keys of an object document (NULL for non-objects)."""
    doc = _c(doc)
    return F.when(F.schema_of_variant(doc).startswith("OBJECT"),
                  F.json_object_keys(F.to_json(doc)))
