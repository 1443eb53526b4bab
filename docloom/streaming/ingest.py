"""Incremental document ingest from a landing folder.

A file stream over ``<landing>/resource=<name>/`` picks up only documents not seen
before (the checkpoint remembers processed files).  Lines are parsed, stamped and
written by Spark's file sink, whose own log makes a micro-batch that is replayed
after a failure count once.  Good and bad lines go to one table, partitioned by
``state``, so the landing folder is read and parsed once.
``trigger(availableNow=True)`` processes what is there and stops, which is
how a daily or polled load runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.operators.nested import stamp
from docloom.sources.landing import parse_landed

LOADED, REJECTED = "loaded", "rejected"


def landed_stream(spark: SparkSession, landing: str, resource: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """New landed lines of one resource (envelope text in ``value``)."""
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(f"{landing.rstrip('/')}/resource={resource}") \
        .select("value", F.lit(resource).alias("resource"))


def ingest_frame(lines: DataFrame, context: list[str]) -> DataFrame:
    """Landed lines -> stamped documents and rejects, told apart by ``state``."""
    parsed = parse_landed(lines, context)
    for k in context:
        parsed = parsed.withColumnRenamed(k, f"request_{k}")
    docs = stamp(parsed, "doc", {k: F.col(f"request_{k}") for k in context})
    return docs.withColumn("state", F.when(F.col("reject").isNull(), LOADED).otherwise(REJECTED))


def start_ingest(spark: SparkSession, landing: str, resource: str, context: list[str],
                 out_root: str, table: str | None = None, stream_name: str | None = None,
                 checkpoint: str | None = None, available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental load of one resource; returns the query (call
    ``awaitTermination()`` on it).  Progress is kept beside the tables, in
    ``<out_root>/_streams/<stream name>``, so another application goes on where
    this one ended."""
    table = table or resource
    name = stream_name or f"ingest-{table}"
    ckpt = checkpoint or f"{out_root.rstrip('/')}/_streams/{name}"
    # a repeated key keeps its last value, whatever session this runs in
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    lines = landed_stream(spark, landing, resource, max_files_per_trigger)
    w = (ingest_frame(lines, context).writeStream.queryName(name).format("parquet").partitionBy("state")
         .option("checkpointLocation", ckpt).option("path", f"{out_root.rstrip('/')}/{table}"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def ingested(spark: SparkSession, out_root: str, table: str) -> DataFrame:
    """The documents that ``start_ingest`` has loaded."""
    t = spark.read.parquet(f"{out_root.rstrip('/')}/{table}")
    return t.where(F.col("state") == LOADED).drop("state", "reject", "line")


def ingest_rejects(spark: SparkSession, out_root: str, table: str) -> DataFrame:
    """The lines that were no documents: resource, reason, line."""
    t = spark.read.parquet(f"{out_root.rstrip('/')}/{table}")
    return t.where(F.col("state") == REJECTED).select("resource", F.col("reject").alias("reason"), "line")
