"""Failures, restarts, changing types, page sizes: what may not change answers."""

import functools
import os
import subprocess
import sys
import types

import pytest
from pyspark.sql import functions as F

from docloom.operators import load as ld
from docloom.operators.flatten import flatten
from docloom.operators.nested import parse_documents
from docloom.session import ensure_checkpoint_dir
from docloom.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def _rows(spark, rows, schema="id string, v int"):
    return spark.createDataFrame(rows, schema)


def _got(spark, root, table="t"):
    return sorted((r.id, r.v) for r in ld.read_table(spark, root, table).collect())


WRITES = {"append": lambda df, root, run: ld.append_load(df, root, "t", run),
          "replace": lambda df, root, run: ld.replace_load(df, root, "t", run),
          "merge": lambda df, root, run: ld.merge_load(df, root, "t", run, ["id"])}


@pytest.mark.parametrize("mode", sorted(WRITES))
@pytest.mark.parametrize("again", ["run-1", "run-2"])
def test_a_failed_write_changes_nothing(spark, scratch, mode, again):
    write = WRITES[mode]
    write(_rows(spark, [("a", 1), ("b", 2)]), scratch, "run-1")
    bad = _rows(spark, [("a", 5), ("c", 6)]).withColumn(
        "v", F.when(F.col("id") == "c", F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        write(bad, scratch, again)
    assert _got(spark, scratch) == [("a", 1), ("b", 2)]
    report = ld.load_report(spark, scratch).first()
    assert (report.n_loads, report.n_failed) == (1, 1)
    write(_rows(spark, [("a", 5), ("c", 6)]), scratch, again)
    want = {("append", "run-1"): [("a", 5), ("c", 6)], ("append", "run-2"): [("a", 1), ("a", 5), ("b", 2), ("c", 6)],
            ("replace", "run-1"): [("a", 5), ("c", 6)], ("replace", "run-2"): [("a", 5), ("c", 6)],
            ("merge", "run-1"): [("a", 5), ("c", 6)], ("merge", "run-2"): [("a", 5), ("b", 2), ("c", 6)]}
    assert _got(spark, scratch) == want[mode, again]


@pytest.mark.parametrize("mode", ["replace", "merge"])
def test_a_load_may_read_the_table_it_writes(spark, scratch, mode):
    WRITES[mode](_rows(spark, [("a", 1)]), scratch, "run-1")
    cur = ld.read_table(spark, scratch, "t")
    WRITES[mode](cur.withColumn("v", F.col("v") + 1), scratch, "run-1")  # the same load again
    assert _got(spark, scratch) == [("a", 2)]


def test_an_unreadable_log_is_an_error(spark, scratch, monkeypatch):
    WRITES["merge"](_rows(spark, [("a", 1), ("b", 2)]), scratch, "run-1")

    def broken(*_):
        raise OSError("no such host")

    monkeypatch.setattr(ld, "load_log", broken)
    with pytest.raises(OSError):
        WRITES["merge"](_rows(spark, [("a", 9)]), scratch, "run-2")
    monkeypatch.undo()
    assert _got(spark, scratch) == [("a", 1), ("b", 2)]


def test_an_empty_retry_clears_its_load(spark, scratch):
    WRITES["append"](_rows(spark, [("a", 1)]), scratch, "run-1")
    WRITES["append"](_rows(spark, [("b", 2)]), scratch, "run-2")
    WRITES["append"](_rows(spark, []), scratch, "run-1")
    assert _got(spark, scratch) == [("b", 2)]


def test_covered_parents_lose_their_old_children(spark, scratch):
    kids = "parent string, v int"
    ld.merge_load(_rows(spark, [("p", 1), ("q", 2)], kids), scratch, "t", "run-1", ["parent"])
    ld.merge_load(_rows(spark, [], kids), scratch, "t", "run-2", ["parent"],
                  covers=_rows(spark, [("p",)], "parent string"))
    assert [(r.parent, r.v) for r in ld.read_table(spark, scratch, "t").collect()] == [("q", 2)]


def test_types_widen_over_loads(spark, scratch):
    for i, (schema, v) in enumerate([("id string, v decimal(4,1)", "101.5"), ("id string, v decimal(4,3)", "9.275"),
                                     ("id string, v int", "7")]):
        df = _rows(spark, [(str(i),)], "id string").select("id", F.lit(v).cast(schema.split()[-1]).alias("v"))
        ld.append_load(df, scratch, "t", f"run-{i}")
    assert _got(spark, scratch) == [("0", 101.5), ("1", 9.275), ("2", 7.0)]
    ld.append_load(_rows(spark, [("3", "x", 1)], "id string, v string, extra int"), scratch, "t", "run-9")
    got = {r.id: (r.v, r.extra) for r in ld.read_table(spark, scratch, "t").collect()}
    assert got["3"] == ("x", 1) and got["2"] == ("7", None)


# ------------------------------------------------------------------ flatten
def _flat(spark, body, **kw):
    d = parse_documents(spark.createDataFrame([("k", body)], "k string, body string"), "body", "doc")
    return flatten(d, "t", ["k"], "doc", **kw)


def test_tables_whose_names_clash_are_both_kept(spark):
    t = _flat(spark, '{"a":{"b":[1,2]},"a__b":[9],"A":{"B":[5]}}')
    values = sorted(sorted(r.value for r in df.collect()) for n, df in t.items() if n != "t")
    assert values == [[1, 2], [5], [9]]
    ids = [r._row_id for n, df in t.items() if n != "t" for r in df.collect()]
    assert len(ids) == len(set(ids)) == 4
    assert len({n.lower() for n in t}) == len(t)


def test_a_stamped_key_gives_one_column(spark):
    d = parse_documents(spark.createDataFrame([("k", '{"date":"p","x":1}')], "k string, body string"), "body", "doc")
    t = flatten(d.withColumn("date", F.lit("p")), "t", ["k"], "doc", keep=["date"], stamped=["date"])["t"]
    assert sorted(c for c in t.columns if not c.startswith("_")) == ["date", "x"]


def test_number_types_do_not_depend_on_the_values(spark):
    for text in ("101.5", "9.275", "1e3"):
        assert dict(_flat(spark, f'{{"v":{text}}}')["t"].dtypes)["v"] == "double"
    assert dict(_flat(spark, '{"v":3}')["t"].dtypes)["v"] == "bigint"


# ------------------------------------------------------------------ session
def test_no_private_folder_on_a_cluster():
    conf = types.SimpleNamespace(get=lambda *_: None)
    sc = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(types.SimpleNamespace(conf=conf, sparkContext=sc))


RESTART = """
import sys
sys.path.insert(0, {repo!r})
from docloom.session import get_session
from docloom.streaming.ingest import ingest_rejects, ingested, start_ingest
spark = get_session(master="local[2]", shuffle_partitions=2)
start_ingest(spark, {land!r}, "scoreboard", ["date"], {out!r}).awaitTermination()
t = ingested(spark, {out!r}, "scoreboard")
bad = ingest_rejects(spark, {out!r}, "scoreboard")
print("ROWS", t.count(), t.select("request_date").distinct().count(), bad.count())
"""


def test_a_second_application_loads_nothing_twice(scratch):
    land, out = f"{scratch}/landing", f"{scratch}/raw"
    os.makedirs(f"{land}/resource=scoreboard")
    with open(f"{land}/resource=scoreboard/a.txt", "w") as f:
        f.write('{"ctx":{"date":"20240101"},"body":{"events":[]}}\n{"ctx":{"date":"20240102"},"body":{}}\ncut {\n')
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for _ in range(2):
        run = subprocess.run([sys.executable, "-c", RESTART.format(repo=repo, land=land, out=out)],
                             capture_output=True, text=True, timeout=300)
        assert "ROWS 2 2 1" in run.stdout, run.stderr[-2000:]


# --------------------------------------------------------------- page sizes
PAGED = ["first_event_summary", "home_away_board", "first_five_transactions", "scoreboard_key_census", "table_census",
         "team_box", "player_stats_list"]


def test_answers_do_not_depend_on_the_page_size(spark, monkeypatch):
    from docloom.plans.registry import QUERIES
    plain = {name: getattr(fx, name) for name in ("day_docs", "board_docs", "event_docs", "group_docs", "roster_docs",
                                                  "tx_docs")}
    seen = {}
    for size in (2, 5, 1000):
        for name, f in plain.items():
            more = {"competitors_per_event": size} if name == "board_docs" else {}
            monkeypatch.setattr(fx, name, functools.partial(f, page_size=size, **more))
        for q in PAGED:
            rows = sorted(map(str, QUERIES[q](spark, SF).collect()))
            assert seen.setdefault(q, rows) == rows, (q, size)


def test_groups_without_a_key_are_kept(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, v int")
    pages = fx.nest_pages(df, ["g"], F.col("v"), F.col("v"), F.col("v").cast("string"), 10)
    assert {r.g: r["items"] for r in pages.collect()} == {None: "[1,2]", "a": "[3]"}
