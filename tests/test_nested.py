import datetime as dt

from pyspark.sql import functions as F

from support import docs_df
from docloom.functions.json import vstr
from docloom.operators.nested import extract_keys, key_census, path_rows, stamp


def test_malformed_json_gives_null_doc(spark):
    d = docs_df(spark, [("a", '{"x":1}'), ("b", "not json"), ("c", '{"x":')])
    got = {r.k: r.doc is None for r in d.collect()}
    assert got == {"a": False, "b": True, "c": True}


def test_path_rows_missing_null_empty(spark):
    d = docs_df(spark, [("a", '{"events":[{"id":"1"},{"id":"2"}]}'), ("b", '{"events":[]}'),
                        ("c", '{"events":null}'), ("d", "{}"), ("e", '{"events":{"id":"x"}}')])
    inner = path_rows(d, "$.events", "doc", "e", pos="p")
    assert sorted((r.k, r.p) for r in inner.collect()) == [("a", 0), ("a", 1)]
    outer = path_rows(d, "$.events", "doc", "e", outer=True)
    assert outer.count() == 6  # a twice, and one NULL row for each of b..e


def test_nested_selector_first_sport_first_league(spark):
    body = ('{"sports":[{"leagues":[{"teams":[{"team":{"id":"1"}},{"team":{"id":"2"}}]},'
            '{"teams":[{"team":{"id":"9"}}]}]},{"leagues":[{"teams":[{"team":{"id":"8"}}]}]}]}')
    d = docs_df(spark, [("t", body)])
    rows = path_rows(d, "$.sports[0].leagues[0].teams", "doc", "t")
    assert [r.i for r in rows.select(vstr("t", "$.team.id").alias("i")).collect()] == ["1", "2"]


def test_extract_keys_drops_falsy_keeps_string_zero(spark):
    body = ('{"events":[{"id":"0"},{"id":0},{"id":""},{"id":null},{},{"id":{}},{"id":[]},'
            '{"id":false},{"id":5},{"id":"401"},{"id":"401"},{"id":true},{"id":[0]}]}')
    d = path_rows(docs_df(spark, [("d", body)]), "$.events", "doc", "e")
    ids = [r.event_id for r in extract_keys(d, "e", "$.id", "id_v").select(
        F.col("id_v").alias("event_id")).collect()]
    assert sorted(ids) == sorted(["0", "5", "401", "401", "true", "[0]"])


def test_stamp_precedence_payload_context_ingested(spark):
    rows = [("20240101", '{"x":1}'),
            ("20240102", '{"date":"payload"}'),
            ("20240103", '{"date":null}'),
            ("20240104", '{"ingested_at":"2020-01-01T00:00:00Z"}')]
    d = docs_df(spark, rows, context=("ctx_date",))
    ts = F.lit(dt.datetime(2025, 1, 1, 12, 0))
    s = stamp(d, "doc", {"date": F.col("ctx_date")}, ingested_at=ts)
    got = {r.ctx_date: (r.date, r.ingested_at) for r in s.collect()}
    assert got["20240101"][0] == "20240101"
    assert got["20240102"][0] == "payload"
    assert got["20240103"][0] is None          # a present null wins
    assert got["20240104"][1].year == 2020     # payload ingested_at wins
    assert got["20240101"][1].year == 2025


def test_key_census(spark):
    d = docs_df(spark, [("a", '{"x":1,"y":null}'), ("b", '{"x":2}'), ("c", "[1]"), ("d", "bad")])
    got = {r.key: r.n_docs for r in key_census(d).collect()}
    assert got == {"x": 2, "y": 1}


def test_repeated_key_keeps_last_value(spark):
    d = docs_df(spark, [("a", '{"id":"1","id":"2"}')])
    assert d.select(vstr("doc", "$.id").alias("i")).collect()[0].i == "2"
