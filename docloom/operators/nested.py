"""Operators on parsed documents: path rows, explode, keys, stamping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.json import parse_doc, top_keys, truthy, varr, vpath, vstr


def _p(key: str) -> str:
    return "$['" + key.replace("'", "\\'") + "']"


def parse_documents(df: DataFrame, body: str = "body", out: str = "doc") -> DataFrame:
    """JSON text -> VARIANT document; malformed text gives NULL."""
    return df.withColumn(out, parse_doc(body))


def path_rows(df: DataFrame, path: str, doc: str = "doc", out: str = "item",
              pos: str | None = None, outer: bool = False, of: str | None = None) -> DataFrame:
    """One row per element of the array at ``path``.

    A missing, null or non-array value yields no row (``outer=True`` keeps the
    parent with a NULL item).  With ``pos`` the 0-based position is kept.

    Items are VARIANT, or of the type ``of``: then the whole array is read in one pass,
    each item with the fields of ``of`` only and by the casts of ``vstr``, ``vlong`` ...
    (what does not cast is NULL).  A VARIANT item is built anew, with its own key list, and
    walked again for each value read from it; that costs several times the typed read."""
    arr = varr(doc, path) if of is None else F.try_variant_get(doc, path, f"array<{of}>")
    keep = [c for c in df.columns]
    if pos:
        gen = F.posexplode_outer(arr) if outer else F.posexplode(arr)
        return df.select(*keep, gen.alias(pos, out))
    gen = F.explode_outer(arr) if outer else F.explode(arr)
    return df.select(*keep, gen.alias(out))


def extract_keys(df: DataFrame, item: str, path: str, out: str) -> DataFrame:
    """Read the id at ``path`` of each item, keep only truthy ids (drops
    missing, null, "", 0, false, {}, []; keeps the string "0").  The id is
    kept as text, never cast to a number."""
    v = vpath(item, path)
    return df.where(truthy(v)).withColumn(out, vstr(v))


def stamp(df: DataFrame, doc: str = "doc", context: dict[str, Column] | None = None,
          ingested_at: Column | None = None) -> DataFrame:
    """Add ``ingested_at`` and context columns to each document.

    Precedence per row: a key present in the payload wins (even when its value
    is JSON null), then the context value, then ``ingested_at``.  One load
    timestamp is used for the whole load (``current_timestamp`` is constant
    within a query)."""
    context = context or {}
    ts = ingested_at if ingested_at is not None else F.current_timestamp()
    ing_payload = vpath(doc, _p("ingested_at"))
    out = df.withColumn(
        "ingested_at",
        F.when(ing_payload.isNotNull(), F.try_to_timestamp(vstr(ing_payload))).otherwise(ts))
    for k, ctx in context.items():
        if k == "ingested_at":
            continue
        pv = vpath(doc, _p(k))
        out = out.withColumn(k, F.when(pv.isNotNull(), vstr(pv)).otherwise(ctx.cast("string")))
    return out


def key_census(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Q6: top-level keys with the number of documents holding each."""
    return (df.select(F.explode(top_keys(doc)).alias("key"))
              .groupBy("key").agg(F.count(F.lit(1)).alias("n_docs")))
