import datetime as dt
import json
import random

from pyspark.sql import functions as F

from docloom.functions.dates import (
    date_range, parse_iso_instant, parse_user_date, season_bounds, season_end_year,
)
from docloom.functions.json import truthy, vpath
from docloom.functions.stats import clock_seconds, made_attempted, signed_int


def _random_json(rng, depth=0):
    kind = rng.choice(["null", "bool", "int", "float", "str", "list", "obj"] if depth < 3
                      else ["null", "bool", "int", "str"])
    if kind == "null":
        return None
    if kind == "bool":
        return rng.random() < 0.5
    if kind == "int":
        return rng.choice([0, 0, 1, -1, 7, 10**12])
    if kind == "float":
        return rng.choice([0.0, -0.0, 0.5, 2.25, 1e-9])
    if kind == "str":
        return rng.choice(["", "0", "false", " ", "x", "null"])
    if kind == "list":
        return [_random_json(rng, depth + 1) for _ in range(rng.choice([0, 0, 1, 2]))]
    return {f"k{i}": _random_json(rng, depth + 1) for i in range(rng.choice([0, 0, 1, 2]))}


def test_truthy_matches_python_truthiness(spark):
    rng = random.Random(7)
    values = [_random_json(rng) for _ in range(400)]
    rows = [(i, json.dumps({"id": v})) for i, v in enumerate(values)]
    rows.append((len(values), json.dumps({})))  # missing key
    df = spark.createDataFrame(rows, "i int, j string").select(
        "i", truthy(vpath(F.try_parse_json("j"), "$.id")).alias("t"))
    got = {r.i: r.t for r in df.collect()}
    for i, v in enumerate(values):
        assert got[i] == bool(v), (v, got[i])
    assert got[len(values)] is False


def test_string_zero_is_truthy_number_zero_is_not(spark):
    df = spark.createDataFrame([('{"id":"0"}',), ('{"id":0}',), ('{"id":0.0}',)], "j string")
    got = [r.t for r in df.select(truthy(vpath(F.try_parse_json("j"), "$.id")).alias("t")).collect()]
    assert got == [True, False, False]


def test_date_range_inclusive_and_reversed(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 30), dt.date(2024, 2, 2)),
                                (dt.date(2024, 2, 2), dt.date(2024, 1, 30)),
                                (dt.date(2024, 2, 2), dt.date(2024, 2, 2)),
                                (None, dt.date(2024, 2, 2))], "a date, b date")
    got = [r.d for r in df.select(date_range("a", "b").alias("d")).collect()]
    assert [len(x) for x in got] == [4, 0, 1, 0]
    assert got[0][0] == dt.date(2024, 1, 30) and got[0][-1] == dt.date(2024, 2, 2)


def test_season_window_resolution(spark):
    cases = [(2025, None, None, "2024-10-01", "2025-06-30"),
             (2025, dt.date(2024, 10, 1), None, "2024-10-01", "2025-06-30"),
             (2025, dt.date(2024, 12, 25), None, "2024-12-25", "2024-12-25"),
             (2025, None, dt.date(2024, 11, 2), "2024-10-01", "2024-11-02"),
             (2025, dt.date(2024, 10, 29), dt.date(2024, 10, 31), "2024-10-29", "2024-10-31")]
    df = spark.createDataFrame([c[:3] for c in cases], "s int, a date, b date")
    s, e = season_bounds(F.col("s"), F.col("a"), F.col("b"))
    got = df.select(s.cast("string").alias("s"), e.cast("string").alias("e")).collect()
    assert [(r.s, r.e) for r in got] == [(c[3], c[4]) for c in cases]
    n = df.select(F.size(date_range(s, e)).alias("n")).collect()[0].n
    assert n == 273  # the 2025 season has 273 days


def test_season_of_day(spark):
    df = spark.createDataFrame([(dt.date(2024, 10, 1),), (dt.date(2025, 6, 30),),
                                (dt.date(2025, 7, 1),), (dt.date(2025, 9, 30),)], "d date")
    assert [r.s for r in df.select(season_end_year("d").alias("s")).collect()] == [2025, 2025, None, None]


def test_user_dates_and_instants(spark):
    df = spark.createDataFrame([("2024-12-25",), ("20241225",), ("2024-13-01",), ("25/12/2024",),
                                ("2025-W01-1",), (None,)], "t string")
    got = [r.d for r in df.select(parse_user_date("t").alias("d")).collect()]
    assert got == [dt.date(2024, 12, 25), dt.date(2024, 12, 25), None, None, None, None]
    ts = spark.createDataFrame([("2024-10-25T23:00Z",), ("2024-10-25T20:00:15Z",), ("bad",)], "t string")
    got = [r.x for r in ts.select(parse_iso_instant("t").alias("x")).collect()]
    assert got == [dt.datetime(2024, 10, 25, 23, 0), dt.datetime(2024, 10, 25, 20, 0, 15), None]


def test_stat_text(spark):
    df = spark.createDataFrame([("35:45", "+15", "45-89"), ("5", "-3", "7-"), ("x:y", "12", None)],
                               "c string, s string, m string")
    made, att = made_attempted(F.col("m"))
    got = df.select(clock_seconds("c").alias("c"), signed_int("s").alias("s"),
                    made.alias("a"), att.alias("b")).collect()
    assert [tuple(r) for r in got] == [(2145, 15, 45, 89), (None, -3, 7, None), (None, 12, None, None)]
