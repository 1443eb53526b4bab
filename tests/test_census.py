from pyspark.sql import functions as F

from support import docs_df
from docloom.operators.census import COUNTS, distinct_values, merge_census, path_census, path_values


def test_every_value_is_counted_by_path_and_type(spark):
    d = docs_df(spark, [("a", '{"x":{"y":[1,"s",null,{"z":true}]},"n":1.5}'), ("b", '{"x":[],"n":null}'), ("c", "not json")])
    got = {r.path: {n: r[n] for n in COUNTS if r[n]} for r in path_census(d, F.lit("1"), 5).collect()}
    assert got == {
        "$": {"n_values": 2, "n_object": 2}, "$.x": {"n_values": 2, "n_object": 1, "n_array": 1},
        "$.n": {"n_values": 2, "n_number": 1, "n_null": 1}, "$.x.y": {"n_values": 1, "n_array": 1},
        "$.x.y[]": {"n_values": 4, "n_number": 1, "n_string": 1, "n_null": 1, "n_object": 1},
        "$.x.y[].z": {"n_values": 1, "n_boolean": 1}}
    assert {r.path for r in path_values(d.select("doc"), 1).collect()} == {"$", "$.x", "$.n"}


def test_merged_census_equals_the_census_of_both(spark):
    text = F.concat(F.lit('{"k":'), (F.col("id") % 5000).cast("string"), F.lit(',"s":["v'), F.col("id").cast("string"), F.lit('"]}'))
    d = spark.range(20000).select(F.col("id"), F.try_parse_json(text).alias("doc"))
    run = (F.col("id") >= 9000).cast("string")
    both = distinct_values(merge_census(path_census(d, run, 2)))
    halves = [path_census(d.where(c), run, 2) for c in ("id < 9000", "id >= 9000")]
    merged = distinct_values(merge_census(*halves))
    key = lambda r: r.path
    assert sorted(merged.collect(), key=key) == sorted(both.collect(), key=key)
    got = {r.path: r for r in merged.collect()}
    assert got["$.k"].n_loads == 2 and abs(got["$.k"].n_distinct - 5000) < 250
    assert abs(got["$.s[]"].n_distinct - 20000) < 1000


def test_one_pass_and_partial_counts(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.range(10).select(F.lit('{"a":{"b":[1]}}').alias("body")).write.parquet(path)
    plan = path_census(spark.read.parquet(path).select(F.try_parse_json("body").alias("doc")), F.lit("1"), 3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "partial_" in text
