"""O10 over a whole group: positions by a distributed prefix sum.

A window over one key ranks a group in one task, however large it is.  Here the
rows are range partitioned by (group, order), so a large group lies in many
adjacent partitions; the rows of each (group, partition) are counted, the counts
before a partition are summed (one small row per group and partition), and a row's
position is that sum plus its rank among its partition's rows of the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.session import ensure_checkpoint_dir


def number_rows(df: DataFrame, group: list[str], order: list[Column], out: str = "pos",
                partitions: int | None = None) -> DataFrame:
    """``df`` with the 0-based position ``out`` (BIGINT) of each row in its group.

    ``order`` should tell rows apart: equal rows get different positions in any
    order, and all of them fall into one range.  Groups may be null.  The ranged
    rows are checkpointed, so a repeated task sees the same partitions."""
    ensure_checkpoint_dir(df.sparkSession)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g).asc_nulls_first() for g in group]
    ranged = df.repartitionByRange(n, *keys, *order).withColumn("_part", F.spark_partition_id()).checkpoint(eager=True)
    cells = ranged.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                           F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    here = Window.partitionBy("_part", *group).orderBy(*order)
    local = ranged.withColumn("_local", F.row_number().over(here) - 1)
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return local.join(offsets, same).select(*df.columns, (F.col("_before") + F.col("_local")).alias(out))


def nth_of_nth(rows: DataFrame, ids: DataFrame, group: list[str], row_order: list[Column], id_order: list[Column],
               out: str = "pos") -> DataFrame:
    """The n-th row of a group with the n-th id of the group; a row beyond the last
    id keeps NULL ids.  Both sides are numbered as above and meet on (group, position)."""
    left = number_rows(rows, group, row_order, out)
    right = number_rows(ids, group, id_order, "_at")
    named = right.select(F.col("_at"), *[F.col(g).alias(f"_k{i}") for i, g in enumerate(group)],
                         *[c for c in ids.columns if c not in group])
    same = F.col(out) == F.col("_at")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_k{i}"))
    return left.join(named, same, "left").drop("_at", *[f"_k{i}" for i in range(len(group))])
