"""Pairing two sides of a list, and name/value lists as columns (inside each
row with higher-order functions: no join, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.json import vstr


def side_classes(rows: DataFrame, group: list[str], side: str, left: str, right: str, values: list[str]) -> DataFrame:
    """Q3: the product of a group's ``left`` and ``right`` rows, factorised.

    One row per (group, side, values) with ``n_entries``, its number of rows, and
    ``n_partners``, the rows on the other side: it stands for n_entries * n_partners
    pairs, so a group of l and r rows costs at most l + r rows instead of l * r.  A
    group without one of the sides gives no rows, as the product does.  Both counts are
    partial aggregates; no group meets in one task."""
    both = rows.where(F.col(side).isin(left, right))
    classes = both.groupBy(*group, side, *values).agg(F.count(F.lit(1)).alias("n_entries"))
    totals = classes.groupBy(*[F.col(g).alias(f"_{g}") for g in group]).agg(
        *[F.sum(F.when(F.col(side) == s, F.col("n_entries")).otherwise(0)).alias(n) for s, n in ((left, "_l"), (right, "_r"))])
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return classes.join(totals.where("_l > 0 AND _r > 0"), same).select(
        *group, side, *values, "n_entries", F.when(F.col(side) == left, F.col("_r")).otherwise(F.col("_l")).alias("n_partners"))


def expand_product(classes: DataFrame, group: list[str], side: str, left: str, right: str, values: list[str],
                   names: tuple[str, str] = ("l", "r")) -> DataFrame:
    """The pairs that ``side_classes`` stands for, each as one row: for groups whose
    pairs are wanted one by one (a day's games), after filtering on the group."""
    one = [classes.where(F.col(side) == s).select(*[F.col(g).alias(f"_{n}{g}" if n == names[1] else g) for g in group],
                                                   *[F.col(v).alias(f"{n}_{v}") for v in values], F.col("n_entries").alias(f"_n{n}"))
           for s, n in ((left, names[0]), (right, names[1]))]
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{names[1]}{g}"))
    times = F.explode(F.array_repeat(F.lit(0), (F.col(f"_n{names[0]}") * F.col(f"_n{names[1]}")).cast("int")))
    return one[0].join(one[1], same).select(*group, *[f"{n}_{v}" for n in names for v in values], times.alias("_x")).drop("_x")


def side_pairs(rows: DataFrame, group: list[str], side: str, left: str, right: str, values: list[str],
               names: tuple[str, str] = ("l", "r")) -> DataFrame:
    """Q3: each pair of a ``left`` and a ``right`` row of a group as one row, by an inner
    join of the two sides on the group (a NULL group is a group).  A group without one of the
    sides gives no rows; Spark splits the tasks of a large one."""
    l, r = [rows.where(F.col(side) == s).select(*[F.col(g).alias(f"_{g}" if s == right else g) for g in group],
                                                *[F.col(v).alias(f"{n}_{v}") for v in values])
            for s, n in ((left, names[0]), (right, names[1]))]
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return l.join(r, same).drop(*[f"_{g}" for g in group])


def name_value_columns(stats: Column, names: list[str], name_path: str = "$.name",
                       value_path: str = "$.value", value_type: str | None = "variant") -> list[Column]:
    """Q4 / V6: one column per stat name from a name/value list, read inside
    the row (the first entry wins when a name repeats; NULL when absent).  The list
    holds VARIANTs, or structs of ``name`` and ``value`` with ``value_type=None``."""
    if value_type is None:
        at = [F.array_position(F.transform(stats, lambda s: s["name"]), n) for n in names]
        return [F.get(stats, (p - 1).cast("int"))["value"].alias(n) for n, p in zip(names, at)]
    cols = []
    for n in names:
        hit = F.get(F.filter(stats, lambda s: vstr(s, name_path) == n), 0)
        cols.append(F.try_variant_get(hit, value_path, value_type).alias(n))
    return cols


def require_all(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows where every listed column is present (jq's empty stream for a
    missing stat drops the whole entry)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)

