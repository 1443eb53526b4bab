"""O18 / Q6 in depth: a census of all paths of a document set, mergeable over loads.

Every value of a document becomes a row (path, value) in one pass over the
documents: the levels are unfolded inside the row, then exploded once.  A path
names object keys after dots and array elements as ``[]``.  Counts are partial
aggregates; distinct scalars are counted by HyperLogLog sketches, so the census
of a new load is merged with the earlier ones without reading their documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTS = ["n_values", "n_null", "n_object", "n_array", "n_string", "n_number", "n_boolean"]
#: log2 of the registers of a sketch (relative error about 1.6 %)
LG_REGISTERS = 12
MEMBERS, ITEMS = "map<string,variant>", "array<variant>"


def _children(node: Column) -> Column:
    value, path = node["value"], node["path"]
    members = F.try_variant_get(value, "$", MEMBERS)
    items = F.try_variant_get(value, "$", ITEMS)
    none = F.array().cast("array<struct<path:string,value:variant>>")
    return (F.when(F.schema_of_variant(value).startswith("OBJECT"), F.transform(
                F.map_entries(members),
                lambda e: F.struct(F.concat(path, F.lit("."), e["key"]).alias("path"), e["value"].alias("value"))))
            .when(F.schema_of_variant(value).startswith("ARRAY"), F.transform(
                items, lambda x: F.struct(F.concat(path, F.lit("[]")).alias("path"), x.alias("value"))))
            .otherwise(none))


def path_values(docs: DataFrame, depth: int, doc: str = "doc") -> DataFrame:
    """One row (path, value) per value down to ``depth`` steps below the document;
    deeper values stay inside the last one.  A document that did not parse has none."""
    levels = ["_level0"]
    df = docs.where(F.col(doc).isNotNull()).withColumn(
        "_level0", F.array(F.struct(F.lit("$").alias("path"), F.col(doc).alias("value"))))
    for k in range(depth):
        df = df.withColumn(f"_level{k + 1}", F.flatten(F.transform(levels[-1], _children)))
        levels.append(f"_level{k + 1}")
    keep = [c for c in docs.columns if c != doc]
    return df.select(*keep, F.explode(F.concat(*levels)).alias("_node")).select(*keep, "_node.path", "_node.value")


def path_census(docs: DataFrame, load: Column, depth: int, doc: str = "doc") -> DataFrame:
    """Per load and path: counts by type and a sketch of the distinct scalars."""
    v = path_values(docs.select(load.cast("string").alias("load_id"), F.col(doc).alias("doc")), depth)
    kind = F.schema_of_variant("value")
    of = {"n_values": F.lit(True), "n_null": kind == "VOID", "n_object": kind.startswith("OBJECT"),
          "n_array": kind.startswith("ARRAY"), "n_string": kind == "STRING",
          "n_number": kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)"), "n_boolean": kind == "BOOLEAN"}
    scalar = F.when(~kind.rlike("^(VOID|OBJECT|ARRAY)"), F.try_variant_get("value", "$", "string"))
    return v.groupBy("load_id", "path").agg(
        *[F.sum(of[n].cast("bigint")).alias(n) for n in COUNTS], F.hll_sketch_agg(scalar, LG_REGISTERS).alias("sketch"))


def merge_census(*parts: DataFrame) -> DataFrame:
    """The census of all loads of ``parts``: sums, united sketches, and for each path
    how many loads hold it and the first and last of them (drift)."""
    u = reduce(DataFrame.unionByName, parts)
    return u.groupBy("path").agg(
        *[F.sum(n).alias(n) for n in COUNTS], F.count_distinct("load_id").alias("n_loads"),
        F.min("load_id").alias("first_load"), F.max("load_id").alias("last_load"),
        F.hll_union_agg("sketch").alias("sketch"))


def distinct_values(census: DataFrame) -> DataFrame:
    """``sketch`` read as an estimate of the number of distinct scalars."""
    return census.withColumn("n_distinct", F.hll_sketch_estimate("sketch")).drop("sketch")
