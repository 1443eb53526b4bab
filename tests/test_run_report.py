"""load_run_report: both runs load rows that were built once, and the same ones as before."""

import datetime as dt

from pyspark.sql import functions as F

from docloom.functions.json import vdouble, vstr
from docloom.operators import load as ld
from docloom.operators.nested import path_rows
from docloom.plans import loads, resources as rs


def tables(spark, root):
    day = dt.datetime(1998, 1, 2)
    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "A")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "ZERO", 0), (1, "ONE", 0), (2, "TWO", 0), (2, "TWO", 0)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(i, f"c{i}", i % 3, i + 0.505, "BUILDING") for i in range(1, 8)] + [(9, None, 1, None, None)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                   "o_orderpriority string",
                   [(i, 1, "FOP"[i % 3], 1.5 * i, day, ("1-URGENT", "2-HIGH")[i % 2]) for i in range(1, 10)]
                   + [(1, 2, "F", None, day, "1-URGENT"), (11, 2, None, 2.0, day, None)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                     "l_shipdate timestamp",
                     [(i, n, n, n, 2.0 * n if n < 3 else None, 5.0, 0.1, 0.2, "A", "F", day) for i in range(1, 12)
                      for n in (1, 2, 3)]),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def test_rows_are_built_once_and_are_the_same(spark, scratch, monkeypatch):
    sf, runs = tables(spark, scratch), []
    real = ld.load_resources

    def seen(resources, *args):
        runs.append(resources)
        return real(resources, *args)

    monkeypatch.setattr(ld, "load_resources", seen)
    report = {r.table_name: (r.n_loads, r.rows_written, r.n_failed) for r in loads.load_run_report(spark, sf).collect()}
    assert len(runs) == 2
    for resources in runs:
        for name in ("rosters", "scoreboard", "game_summary"):
            files = resources[name][0].inputFiles()
            assert files and all(f"/_rows/{name}/" in f for f in files), name
    # the rows as read item by item
    want = {
        "rosters": path_rows(rs.rosters(spark, sf), "$.athletes", "doc", "a").select(
            "team_id", vstr("a", "$.id").alias("athlete_id"), F.round(vdouble("a", "$.salary"), 2).alias("salary")),
        "scoreboard": path_rows(rs.scoreboard(spark, sf), "$.events", "doc", "event").select(
            "request_date", vstr("event", "$.uid").alias("uid")),
        "game_summary": path_rows(rs.game_summary(spark, sf), "$.lines", "doc", "line").select(
            "request_date", "request_event_id", vdouble("line", "$.qty").alias("qty")),
    }
    for name, rows in want.items():
        got = runs[0][name][0]
        assert got.columns == rows.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, rows.collect())), name
        assert report[name] == (1, rows.count(), 0)
    assert report["game_summary"][1] > 0
