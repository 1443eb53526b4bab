"""Whole answers and bounded steps on tables of the tests' own rows."""
import os

from pyspark.sql import functions as F

from docloom.operators import load as ld
from docloom.operators.flatten import flatten
from docloom.operators.nested import path_rows
from docloom.plans.queries import home_away_board
from docloom.sources import fixtures as fx
from docloom.sources.landing import write_landed
from support import docs_df


def board_tables(spark, folder):
    spark.sql("SELECT * FROM VALUES (1L, 5L, 'F', 10D, TIMESTAMP_NTZ'1997-01-02 00:00:00', '1-URGENT'),"
              " (2L, 5L, 'O', 10D, TIMESTAMP_NTZ'1997-01-02 00:00:00', '1-URGENT')"
              " AS t(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)") \
        .write.parquet(f"{folder}/orders.parquet")
    line = "{k}L, {p}L, {s}L, {n}, {q}D, 1D, 0.0D, 0.0D, 'A', 'F', TIMESTAMP_NTZ'1997-01-05 00:00:00'"
    rows = [(1, 1, 7, 1, 4), (1, 1, 7, 1, 4), (1, 2, 8, 3, 5), (1, 3, 9, 2, 6), (1, 4, 9, 4, 7), (2, 1, 7, 1, 4)]
    spark.sql("SELECT * FROM VALUES " + ", ".join("(" + line.format(k=k, p=p, s=s, n=n, q=q) + ")" for k, p, s, n, q in rows)
              + " AS t(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,"
                " l_returnflag, l_linestatus, l_shipdate)").write.parquet(f"{folder}/lineitem.parquet")


def test_home_away_board_gives_each_pair(spark, scratch):
    board_tables(spark, scratch)
    got = sorted((r.event_id, r.home_team, r.home_score, r.away_team, r.away_score)
                 for r in home_away_board(spark, scratch).collect())
    home = [("Supplier 7", 4), ("Supplier 7", 4), ("Supplier 8", 5)]
    away = [("Supplier 9", 6), ("Supplier 9", 7)]
    assert got == sorted(("1", *h, *a) for h in home for a in away)


def test_loads_have_small_row_groups(spark, scratch):
    from pyarrow import parquet
    df = spark.range(300, numPartitions=1).select("id", F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(3000)), lambda i: F.sha2(F.concat(F.col("id").cast("string"), i.cast("string")), 256)),
        "").alias("text"))
    ld.append_load(df, scratch, "t", "run-1")
    files = [os.path.join(d, f) for d, _, fs in os.walk(f"{scratch}/t") for f in fs if f.endswith(".parquet")]
    meta = [parquet.ParquetFile(f).metadata for f in files]
    groups = [m.row_group(i) for m in meta for i in range(m.num_row_groups)]
    assert max(sum(g.column(c).total_compressed_size for c in range(g.num_columns)) for g in groups) < 30 << 20
    assert ld.read_table(spark, scratch, "t").count() == 300


def test_landed_documents_are_compressed(spark, scratch):
    docs = spark.range(2000).select(F.lit("r").alias("resource"), F.col("id").cast("string").alias("k"),
                                    F.lit('{"a":"' + "text " * 100 + '"}').alias("body"))
    write_landed(docs, scratch, ["k"])
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(scratch) for f in fs)
    assert size < 2000 * 500 / 5
    assert spark.read.text(f"{scratch}/resource=r").count() == 2000



def test_documents_are_shuffled_once_and_as_read(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pages = fx.nest_pages(df, ["g"], F.col("id"), F.col("id"), fx.jobj(fx.kv("n", F.col("id").cast("string"))), 10)
        plan = pages._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" not in plan  # the count's and the rows'
    assert pages.agg(F.sum("n_items")).first()[0] == 100 and pages.agg(F.max("n_items")).first()[0] <= 10


def test_typed_items_are_those_of_the_paths(spark):
    body = '{"a":[{"n":1,"s":"x","o":{"b":true}},{"n":"7","s":{"k":1}},null,5,{"n":"y","o":[]}]}'
    d = docs_df(spark, [("1", body), ("2", '{"a":{}}'), ("3", "{}"), ("4", '{"a":null}')])
    typed = path_rows(d, "$.a", "doc", "i", of="struct<n:bigint, s:string, o:struct<b:boolean>>") \
        .select("i.n", "i.s", F.col("i.o.b").alias("b"))
    plain = path_rows(d, "$.a", "doc", "i").select(*[F.try_variant_get("i", p, t).alias(n) for n, p, t in (
        ("n", "$.n", "bigint"), ("s", "$.s", "string"), ("b", "$.o.b", "boolean"))])
    assert [tuple(r) for r in typed.collect()] == [tuple(r) for r in plain.collect()] and typed.count() == 5


def test_flatten_reads_children_typed(spark):
    body = '{"e":[{"id":1,"c":{"l":[{"x":"a","Y":1.5,"z":[1,2]},null]}},{"id":"2","c":{}},{"id":3,"c":{"l":[{"x":4}]}}]}'
    t = flatten(docs_df(spark, [("1", body)]), "d", ["k"])
    rows = t["d__e__c__l"]
    assert sorted((r["_list_idx"], r["x"], r["Y"]) for r in rows.where("x IS NOT NULL").collect()) == [(0, "4", None), (0, "a", 1.5)]
    assert rows.count() == 3 and t["d__e__c__l__z"].count() == 2
    assert "as variant" not in rows._jdf.queryExecution().optimizedPlan().toString().lower()
    assert rows.join(t["d__e"], rows["_parent_id"] == t["d__e"]["_row_id"], "left_anti").count() == 0
