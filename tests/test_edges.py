"""Edge documents (hand-written) through the operators end to end."""

from pyspark.sql import functions as F

from support import docs_df
from docloom.functions.json import varr, vstr
from docloom.operators.chain import chain
from docloom.operators.flatten import flatten
from docloom.operators.nested import extract_keys, path_rows, stamp


def test_ids_repeated_within_and_across_days_keep_multiplicity(spark):
    days = docs_df(spark, [("20240101", '{"events":[{"id":"7"},{"id":"7"},{"id":null}]}'),
                           ("20240102", '{"events":[{"id":"7"},{"id":0}]}'),
                           ("20240103", '{"events":null}'),
                           ("20240104", '{"day":{}}')], context=("date",))
    ids = extract_keys(path_rows(days, "$.events", "doc", "e"), "e", "$.id", "event_id") \
        .select("date", "event_id")
    summaries = docs_df(spark, [("7", '{"header":{"id":"7"},"lines":[{"n":1},{"n":2}]}')],
                        context=("request_event_id",))
    g = chain(ids, summaries, "event_id", "request_event_id")
    g = stamp(g, "doc", {"event_id": F.col("event_id")})
    lines = path_rows(g, "$.lines", "doc", "l")
    got = sorted((r.date, r.n) for r in lines.select("date", vstr("l", "$.n").alias("n")).collect())
    assert got == [("20240101", "1"), ("20240101", "1"), ("20240101", "2"), ("20240101", "2"),
                   ("20240102", "1"), ("20240102", "2")]


def test_null_where_object_or_array_expected_yields_no_rows(spark):
    d = docs_df(spark, [("a", '{"competitions":null}'), ("b", '{"competitions":[null]}'),
                        ("c", '{"competitions":[{"competitors":null}]}'), ("d", '"text"')])
    comps = path_rows(d, "$.competitions[0].competitors", "doc", "c")
    assert comps.count() == 0
    first = d.select("k", F.get(varr("doc", "$.competitions"), 0).alias("c0"))
    assert {r.k: r.c0 is None for r in first.collect()} == {"a": True, "b": False, "c": False, "d": True}


def test_arrays_nested_three_deep(spark):
    d = docs_df(spark, [("a", '{"x":[{"y":[{"z":[1,2]},{"z":[]}]},{"y":[]}]}'),
                        ("b", '{"x":[{"y":[{"z":[3]}]}]}')])
    t = flatten(d, "t", ["k"])
    assert set(t) == {"t", "t__x", "t__x__y", "t__x__y__z"}
    z = t["t__x__y__z"]
    assert sorted(r.value for r in z.collect()) == [1, 2, 3]
    # each leaf reaches its root through the parents
    y = t["t__x__y"].select(F.col("_row_id").alias("_parent_id"), F.col("_root_id").alias("rid"))
    assert z.join(y, "_parent_id").where(F.col("_root_id") != F.col("rid")).count() == 0
    capped = flatten(d, "t", ["k"], max_depth=2)
    assert set(capped) == {"t", "t__x", "t__x__y"}
    assert sorted(r.z for r in capped["t__x__y"].collect()) == ["[1,2]", "[3]", "[]"]


def test_unequal_label_and_value_lengths(spark):
    d = docs_df(spark, [("a", '{"labels":["A","B","C"],"v":["1","2"]}'),
                        ("b", '{"labels":["A"],"v":["1","2"]}')])
    z = d.select("k", F.inline(F.arrays_zip(
        F.transform(varr("doc", "$.labels"), lambda x: vstr(x)).alias("label"),
        F.transform(varr("doc", "$.v"), lambda x: vstr(x)).alias("value"))))
    got = sorted((r.k, r.label or "", r.value or "") for r in z.collect())
    assert got == [("a", "A", "1"), ("a", "B", "2"), ("a", "C", ""), ("b", "", "2"), ("b", "A", "1")]
