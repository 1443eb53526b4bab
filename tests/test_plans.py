"""Plan shapes that carry the scale properties: no join / shuffle where the
work is row-local, partial aggregation before shuffles, page-level shuffles,
filters reaching the scan."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from support import SF_SMALL, docs_df
from docloom.functions.json import varr, vstr
from docloom.operators import load as ld
from docloom.operators.nested import path_rows
from docloom.operators.bloom import wanted
from docloom.operators.intervals import interval_join
from docloom.operators.pairs import expand_product, name_value_columns, side_classes
from docloom.operators.positions import number_rows
from docloom.sources import fixtures as fx
from docloom.sources.landing import context_value, read_landed
from docloom.sources.tables import load_table


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_product_of_sides_is_factorised(spark):
    """A crowded event costs h + a rows, and they stand for exactly the product."""
    rng = random.Random(1)
    rows = [("big", rng.choice(["home", "away", "other"]), f"t{rng.randint(0, 30)}", rng.choice([1, 2, None])) for _ in range(400)]
    rows += [("one", "home", "h", 1), ("two", "away", "a", 1), (None, "home", "h", 5), (None, "away", "a", None)]
    df = spark.createDataFrame(rows, "id string, side string, team string, n int").repartition(5)
    c = side_classes(df, ["id"], "side", "home", "away", ["team", "n"])
    assert c.count() <= len(rows) and c.where("id in ('one', 'two')").count() == 0
    pairs = expand_product(c, ["id"], "side", "home", "away", ["team", "n"])
    want = [(h[0], h[2], h[3], a[2], a[3]) for h in rows for a in rows if h[0] == a[0] and h[1] == "home" and a[1] == "away"]
    assert Counter(tuple(r) for r in pairs.collect()) == Counter(want)
    assert c.selectExpr("sum(n_entries * n_partners) / 2").first()[0] == len(want)
    assert "Window" not in _plan(c) and "partial_count" in _plan(c)


def test_first_five_are_limited_before_the_shuffle(spark):
    from docloom.plans.queries import first_five_transactions
    plan = _plan(first_five_transactions(spark, SF_SMALL))
    assert re.search(r"WindowGroupLimit .*Partial", plan) and re.search(r"WindowGroupLimit .*Final", plan)


def test_a_hot_group_is_numbered_by_many_tasks(spark):
    n = 20_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
                               (F.col("id") * 7919 % n).alias("o")).union(
        spark.createDataFrame([(None, 1), (None, None), (None, 0)], "g string, o long"))
    out = number_rows(df, ["g"], [F.col("o").asc_nulls_first()], partitions=16)
    got = {}
    for r in out.collect():
        got.setdefault(r.g, {})[r.pos] = r.o
    assert sum(map(len, got.values())) == n + 3 and got[None] == {0: None, 1: 0, 2: 1}
    for g, at in got.items():
        if g:
            assert [at[i] for i in range(len(at))] == sorted(at.values())
    # no window over the group alone: ranks are per partition, sums over one row per partition
    windows = re.findall(r"windowspecdefinition\(([^)]*?) ASC", _plan(out))
    assert any("_part" in w.split(",")[0] for w in windows)
    assert out.sparkSession.createDataFrame([], "g string, o long").count() == 0
    assert number_rows(df.limit(0), ["g"], [F.col("o")]).count() == 0


def test_intervals_meet_in_bins(spark):
    rng = random.Random(2)
    w = [(i, rng.randint(-50, 1000), rng.randint(-50, 1000)) for i in range(150)] + [(900, None, 3), (901, 5, 5), (902, -3, 2 ** 40)]
    r = [(i, rng.randint(-60, 1010)) for i in range(300)] + [(600, None), (601, 2 ** 39), (602, -3)]
    hit = interval_join(spark.createDataFrame(r, "r int, a long"), F.col("a"), spark.createDataFrame(w, "w int, s long, e long"),
                        F.col("s"), F.col("e"))
    want = sorted((i, j) for i, a in r for j, s, e in w if a is not None and s is not None and s <= a <= e)
    assert sorted((x.r, x.w) for x in hit.collect()) == want
    assert "NestedLoop" not in _plan(hit) and "Cartesian" not in _plan(hit)


def test_a_bloom_filter_stands_before_the_parse(spark, scratch):
    """Unwanted lines are not parsed; wrongly kept ones go in the join."""
    n = 4000
    lines = spark.range(n).select(F.concat(F.lit('{"ctx":{"id":"'), F.col("id"), F.lit('"},"body":{"v":1}}')).alias("value"),
                                  F.lit("x").alias("resource"))
    scratch = f"{scratch}/landing"
    lines.write.partitionBy("resource").text(scratch)
    ids = spark.range(0, n, 40).select(F.col("id").cast("string").alias("id"))
    docs = read_landed(spark, scratch, "x", ["id"], where=wanted(context_value("id"), ids, "id"))
    kept = {r.id for r in docs.select("id").collect()}
    assert {str(i) for i in range(0, n, 40)} <= kept and len(kept) < 100 + n * 0.06
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    parse, test = plan.index("parseJson"), plan.index("getbit")
    assert parse < test  # the parse is above the filter in the plan, so it comes after it
    assert docs.join(ids, "id").count() == 100
    none = read_landed(spark, scratch, "x", ["id"], where=wanted(context_value("id"), ids.limit(0), "id"))
    assert none.count() == 0


def test_one_day_is_a_range_on_the_scan(spark):
    from docloom.plans.queries import games_of_day
    plan = games_of_day(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_windows_join_on_days_behind_literal_bounds(spark):
    from docloom.plans.queries import season_1998_orders
    plan = season_1998_orders(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "NestedLoop" not in plan

def test_name_value_lookup_is_row_local(spark):
    body = '{"stats":[{"name":"wins","value":3},{"name":"losses","value":1},{"name":"wins","value":9}]}'
    d = docs_df(spark, [("a", body)])
    w, l, p = name_value_columns(varr("doc", "$.stats"), ["wins", "losses", "pct"], value_type="bigint")
    r = d.select(w, l, p).collect()[0]
    assert (r.wins, r.losses, r.pct) == (3, 1, None)
    assert "Exchange" not in _plan(d.select(w, l, p))


def test_document_pages_shuffle_on_group_and_page(spark):
    o = load_table(spark, SF_SMALL, "orders")
    pages = fx.nest_pages(o, ["o_custkey"], F.col("o_orderkey"), F.col("o_orderkey"),
                          F.col("o_orderkey").cast("string"), 10)
    plan = _plan(pages)
    assert "hashpartitioning(o_custkey" in plan and ", page" in plan


def test_upsert_has_no_extra_aggregate(spark):
    a = spark.createDataFrame([("1", 1)], "id string, v int")
    b = spark.createDataFrame([("1", 2)], "id string, v int")
    plan = _plan(ld.upsert(a, b, ["id"]))
    assert "LeftAnti" in plan and "HashAggregate" not in plan


def test_day_filter_reaches_loaded_scan(spark, scratch):
    df = spark.createDataFrame([("a", "19970315"), ("b", "19970316")], "id string, request_date string")
    ld.append_load(df, scratch, "t", "run-1", cluster_by=["request_date"])
    t = ld.read_table(spark, scratch, "t").where(F.col("request_date") == "19970315")
    assert "PushedFilters: [IsNotNull(request_date), EqualTo(request_date,19970315)]" in _plan(t)
    assert t.count() == 1
