"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame whose
column names match the SQL oracle of the same name (``plans/oracle.py``).

Outputs avoid session-dependent types: days are 'yyyyMMdd' / 'yyyy-MM-dd'
text, doubles are rounded to 2 places, counts are BIGINT.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions.json import top_keys, truthy, varr, vdouble, vlong, vpath, vstr
from docloom.operators import requests as rq
from docloom.operators.census import merge_census, path_census
from docloom.operators.chain import chain, missing_documents, skipped_groups
from docloom.operators.intervals import interval_join, micros
from docloom.operators.load import upsert, latest
from docloom.operators.nested import path_rows
from docloom.operators.pairs import expand_product, name_value_columns, require_all, side_classes, side_pairs
from docloom.operators.positions import nth_of_nth, number_rows
from docloom.plans import resources as rs
from docloom.sources.tables import load_table


def _orders(spark, sf_dir):
    return load_table(spark, sf_dir, "orders")


# ------------------------------------------------------------ O1, O3
def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + O3: every day of the order span, its scoreboard request
    parameter and the number of orders that day (0 for empty days)."""
    o = _orders(spark, sf_dir)
    days = rq.span_calendar(o, "o_orderdate", "day")
    per_day = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(per_day, "day", "left").select(
        F.date_format("day", "yyyyMMdd").alias("date"),
        F.concat(F.lit("dates="), F.date_format("day", "yyyyMMdd")).alias("params"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_orders"))


def ship_window_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 per row: for each order, the days from its order date to its first
    shipment, inclusive; orders shipped before they were placed give no day.
    Reported per order: number of days and the last day."""
    o = _orders(spark, sf_dir)
    li = load_table(spark, sf_dir, "lineitem")
    first_ship = li.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))
    w = o.join(first_ship, o.o_orderkey == first_ship.l_orderkey)
    days = rq.expand_days(w, "o_orderdate", "first_ship", "day")
    return days.groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.date_format(F.max("day"), "yyyyMMdd").alias("last_day"))


# ------------------------------------------------------------ O2
def season_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: orders per season (Oct 1 .. Jun 30), July-September excluded."""
    o = rq.with_season(_orders(spark, sf_dir), "o_orderdate")
    return o.where(F.col("season_end_year").isNotNull()).groupBy("season_end_year").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.date_format(F.min("o_orderdate"), "yyyyMMdd").alias("first_date"),
        F.date_format(F.max("o_orderdate"), "yyyyMMdd").alias("last_date"),
        F.round(F.sum("o_totalprice"), 2).alias("revenue")) \
        .withColumn("season_end_year", F.col("season_end_year").cast("int"))


# Parameter rows for the window-resolution cases (fixed values).
SEASON_CASES = [
    ("season_only", 1998, None, None),
    ("start_is_season_start", 1998, dt.date(1997, 10, 1), None),
    ("start_only", 1998, dt.date(1998, 3, 15), None),
    ("end_only", 1998, None, dt.date(1997, 12, 31)),
    ("both", 1998, dt.date(1998, 1, 10), dt.date(1998, 2, 20)),
    ("reversed", 1998, dt.date(1998, 5, 1), dt.date(1998, 4, 1)),
]


def season_window_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: resolve each parameter case into a window and count the orders in
    it.  A reversed window holds nothing."""
    params = spark.createDataFrame(
        SEASON_CASES, "case_name string, season int, start_date date, end_date date")
    win = rq.resolve_windows(params)
    hit = rq.in_window(_orders(spark, sf_dir), "o_orderdate", win)
    return hit.groupBy("case_name", "window_start", "window_end").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.round(F.sum("o_totalprice"), 2).alias("revenue")).select(
        "case_name",
        F.date_format("window_start", "yyyy-MM-dd").alias("window_start"),
        F.date_format("window_end", "yyyy-MM-dd").alias("window_end"),
        "n_orders", "revenue")


def season_1998_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2 default window of season 1998 (1997-10-01 .. 1998-06-30): its orders."""
    params = spark.createDataFrame([(1998, None, None)], "season int, start_date date, end_date date")
    span = (dt.date(1997, 10, 1), dt.date(1998, 6, 30))
    hit = rq.in_window(_orders(spark, sf_dir), "o_orderdate", rq.resolve_windows(params), span)
    return hit.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("date"))


def event_windows(spark: SparkSession, sf_dir: str, minutes: int = 10) -> DataFrame:
    """O2 on timestamps, with as many overlapping windows as there are sign-ups: the
    events in the ten minutes from each sign-up on, both ends included."""
    e = load_table(spark, sf_dir, "events")
    at = micros("ts")
    w = e.where("event_type = 'signup'").select(F.col("event_id").alias("signup"), at.alias("start"))
    hit = interval_join(e.select("event_id", "ts", "value"), at, w, F.col("start"),
                        F.col("start") + minutes * 60 * 1_000_000)
    return hit.groupBy("signup").agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 2).alias("value"))


# ------------------------------------------------------------ O3, O12
def request_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: every request of a full run: a scoreboard per day of the order
    span, the teams list, a roster per truthy team id, a summary per truthy
    event id (with its day)."""
    days = rq.span_calendar(_orders(spark, sf_dir), "o_orderdate", "day")
    return (rq.scoreboard_requests(days)
            .unionByName(rq.teams_request(spark))
            .unionByName(rq.roster_requests(rs.team_ids(spark, sf_dir)))
            .unionByName(rq.summary_requests(rs.event_ids(spark, sf_dir))))


def resource_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest restricted to ``schedule`` (alias of scoreboard) and
    ``rosters``, counted per resource."""
    m = rq.select_resources(request_manifest(spark, sf_dir), ["schedule", " rosters"])
    return m.groupBy("resource").agg(F.count(F.lit(1)).alias("n_requests"))


# ------------------------------------------------------------ O13
def date_text_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date text in three forms -- final orders 'yyyy-MM-dd', open orders
    'yyyyMMdd', pending orders their priority text (not a date) -- split into
    valid rows and rejected rows with a reason."""
    o = _orders(spark, sf_dir).select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
         .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyyMMdd"))
         .otherwise(F.col("o_orderpriority")).alias("date_text"))
    valid, rejected = rq.validate_dates(o, "date_text", "parsed")
    cols = ["o_orderkey", "date_text", F.date_format("parsed", "yyyy-MM-dd").alias("parsed_date")]
    return valid.select(*cols, F.lit(None).cast("string").alias("reason")) \
        .unionByName(rejected.select(*cols, "reason"))


# ------------------------------------------------------------ O4, O4b, O5, O6, O7, O10
def props_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4 on a real JSON column: ``events.props`` -> ``k``."""
    e = load_table(spark, sf_dir, "events").withColumn("p", F.try_parse_json("props"))
    return e.select("event_id", "user_id", "event_type", vlong("p", "$.k").alias("k"))


def _event_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested event documents in two loads; a key of the second is new."""
    odd = F.col("event_id") % 2 == 1
    body = F.concat(
        F.lit('{"type":"'), F.col("event_type"), F.lit('","value":'), F.coalesce(F.col("value").cast("string"), F.lit("null")),
        F.lit(',"props":'), F.coalesce("props", F.lit("null")), F.lit(',"marks":['), (F.col("user_id") % 3).cast("string"),
        F.lit(',null,{"late":'), odd.cast("string"), F.lit("}]"),
        F.when(odd, F.concat(F.lit(',"user":{"id":"'), F.col("user_id").cast("string"), F.lit('"}'))).otherwise(F.lit("")),
        F.lit("}"))
    return load_table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), (F.col("event_id") % 2).cast("string")).alias("load_id"), F.try_parse_json(body).alias("doc"))


def event_path_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O18 / Q6 at all depths: the censuses of two loads of event documents, merged."""
    docs = _event_bodies(spark, sf_dir)
    parts = [path_census(docs.where(F.col("load_id") == run), F.col("load_id"), 3) for run in ("run-0", "run-1")]
    return merge_census(*parts).drop("sketch")


def scoreboard_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4 + O7 + O5a: every event of every scoreboard document with the day
    it was requested for."""
    ev = rs.scoreboard_events(spark, sf_dir)
    return ev.select(
        F.col("request_date").alias("date"),
        vstr("event", "$.uid").alias("uid"),
        vstr("event", "$.status.type.name").alias("status"),
        F.round(vdouble("event", "$.total"), 2).alias("total"))


def teams_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``$.sports[0].leagues[0].teams`` -- first sport, first league."""
    t = rs.teams(spark, sf_dir)
    return t.select(vstr("team", "$.team.id").alias("team_id"),
                    vstr("team", "$.team.displayName").alias("display_name"),
                    vstr("team", "$.team.abbreviation").alias("abbreviation"),
                    vstr("doc", "$.sports[0].name").alias("sport"))


def stamp_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stamped ``date`` of each scoreboard document: the payload's own
    ``date`` key wins when present (also when it is null), else the request
    day."""
    s = rs.scoreboard(spark, sf_dir)
    return s.select("request_date", "page", "date",
                    F.array_size(varr("doc", "$.events")).cast("bigint").alias("n_events"))


def truthy_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids that pass the truthiness filter, with their day."""
    return rs.event_ids(spark, sf_dir)


def event_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of each event entry in its document (0-based)."""
    ev = rs.scoreboard_events(spark, sf_dir, pos=True)
    return ev.select(F.col("request_date").alias("date"), "page", F.col("pos").cast("int").alias("pos"),
                     vstr("event", "$.uid").alias("uid"))


def status_event_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O10 over whole groups: the position of each event among all events of its
    status, over all documents.  A status holds up to half of all rows; it is
    numbered by many tasks."""
    ev = rs.scoreboard_events(spark, sf_dir).select(
        vstr("event", "$.status.type.name").alias("status"), vstr("event", "$.uid").alias("uid"),
        F.regexp_extract(vstr("event", "$.uid"), r"~e:(\d+)$", 1).cast("bigint").alias("n"))
    return number_rows(ev, ["status"], [F.col("n")]).select("status", "pos", "uid")


def nth_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O10 by place: the n-th event entry of a day gets the n-th truthy id of the day;
    entries beyond the last id get NULL."""
    ev = rs.scoreboard_events(spark, sf_dir)
    n = F.regexp_extract(vstr("event", "$.uid"), r"~e:(\d+)$", 1).cast("bigint")
    rows = ev.select(F.col("request_date").alias("date"), vstr("event", "$.uid").alias("uid"), n.alias("n"))
    ids = rs.event_ids(spark, sf_dir).withColumn("m", F.col("event_id").cast("bigint"))
    return nth_of_nth(rows, ids, ["date"], [F.col("n")], [F.col("m")]).select("date", "pos", "uid", "event_id")


# ------------------------------------------------------------ O8, O9, O11
def roster_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team ids from the teams document -> roster documents -> athletes."""
    r = path_rows(rs.rosters(spark, sf_dir), "$.athletes", "doc", "a")
    return r.select("team_id", vstr("a", "$.id").alias("athlete_id"),
                    vstr("a", "$.displayName").alias("athlete_name"),
                    F.round(vdouble("a", "$.salary"), 2).alias("salary"))


def summary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day -> events -> summary documents -> their line rows."""
    g = path_rows(rs.game_summary(spark, sf_dir), "$.lines", "doc", "line")
    return g.select("date", "event_id",
                    vlong("line", "$.n").alias("line_no"),
                    vlong("line", "$.part").alias("part"),
                    F.round(vdouble("line", "$.qty"), 2).alias("qty"),
                    F.round(vdouble("line", "$.price"), 2).alias("price"))


def missing_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested events with no landed summary document."""
    return missing_documents(rs.event_ids(spark, sf_dir), rs.summary_docs(spark, sf_dir),
                             "event_id", "request_event_id").select("date", "event_id")


def skipped_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the span that yield no summary request."""
    days = rq.span_calendar(_orders(spark, sf_dir), "o_orderdate", "day") \
        .select(F.date_format("day", "yyyyMMdd").alias("date"))
    return skipped_groups(days, rs.event_ids(spark, sf_dir), "date")


# ------------------------------------------------------------ Q1..Q7
def games_of_day(spark: SparkSession, sf_dir: str, day: str = "19970315") -> DataFrame:
    """Q1: the games of one day (a filter on the request day column)."""
    ev = path_rows(rs.scoreboard(spark, sf_dir, dt.datetime.strptime(day, "%Y%m%d").date())
                   .where(F.col("request_date") == day), "$.events", "doc", "event")
    return ev.select(F.col("request_date").alias("date"), vstr("event", "$.uid").alias("uid"),
                     vstr("event", "$.name").alias("name"),
                     vstr("event", "$.status.type.description").alias("status"))


def first_event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: the first event of each day, over all of the day's documents, then
    its summary: number of lines and total quantity.  The first event of each
    document is a bounded candidate; the day's first is the least of them."""
    sb = rs.scoreboard(spark, sf_dir)
    first = sb.select(F.col("request_date").alias("date"), F.get(varr("doc", "$.events"), 0).alias("event"))
    first = first.select("date", F.regexp_extract(vstr("event", "$.uid"), r"~e:(\d+)$", 1).cast("bigint").alias("n"),
                         truthy(vpath("event", "$.id")).alias("ok"), vstr("event", "$.id").alias("event_id"))
    ids = first.groupBy("date").agg(F.min_by(F.struct("ok", "event_id"), "n").alias("e")) \
        .where("e.ok").select("date", F.col("e.event_id").alias("event_id"))
    only = ids.select(F.col("event_id").cast("bigint").alias("o_orderkey"))
    docs = rs.summary_docs(spark, sf_dir, only).drop("page", "event_id", "ingested_at")
    lines = path_rows(chain(ids, docs, "event_id", "request_event_id"), "$.lines", "doc", "line")
    return lines.groupBy("date", "event_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.round(F.sum(vdouble("line", "$.qty")), 2).alias("sum_qty"))


def _sides(board: DataFrame) -> DataFrame:
    """Competitors of scoreboard documents: event_id, name, status, side, team, score."""
    ev = path_rows(board, "$.events", "doc", "event", of="""struct<id:string, name:string,
        status:struct<type:struct<description:string>>, competitions:array<struct<competitors:array<struct<
        homeAway:string, score:string, team:struct<displayName:string>>>>>>""")
    c = ev.select(F.col("event.id").alias("event_id"), F.col("event.name").alias("name"),
                  F.col("event.status.type.description").alias("status"),
                  F.explode(F.get("event.competitions", 0)["competitors"]).alias("c"))
    return c.select("event_id", "name", "status", F.col("c.homeAway").alias("side"),
                    F.col("c.team.displayName").alias("team"), F.col("c.score").try_cast("int").alias("score"))


def home_away_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: home x away of every event: one row per pair of a home and an away
    competitor, whatever documents the two came in.  Events without a home or an away
    side fall out."""
    return side_pairs(_sides(rs.board(spark, sf_dir)), ["event_id", "name", "status"], "side", "home", "away",
                      ["team", "score"], ("home", "away"))


def home_away_of_day(spark: SparkSession, sf_dir: str, day: str = "19970315") -> DataFrame:
    """Q3 as documented, for the games of one day: one row per pair of a home and an
    away competitor of an event."""
    c = _sides(rs.board(spark, sf_dir).where(F.col("request_date") == day))
    group = ["event_id", "name", "status"]
    classes = side_classes(c, group, "side", "home", "away", ["team", "score"])
    return expand_product(classes, group, "side", "home", "away", ["team", "score"], ("home", "away"))


def standings_key_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: first child group's entries with wins, losses and winPercent turned
    into columns; an entry missing any of the three is dropped.  Stats are
    looked up inside each entry (no shuffle); with a repeated stat name the
    first one counts."""
    e = path_rows(rs.standings_docs(spark, sf_dir), "$.children[0].standings.entries", "doc", "e")
    wins, losses, pct = name_value_columns(varr("e", "$.stats"), ["wins", "losses", "winPercent"])
    out = e.select(vstr("e", "$.team.id").alias("team_id"),
                   vstr("e", "$.team.displayName").alias("team"),
                   F.try_variant_get(wins, "$", "bigint").alias("wins"),
                   F.try_variant_get(losses, "$", "bigint").alias("losses"),
                   F.try_variant_get(pct, "$", "double").alias("win_pct"))
    return require_all(out, ["wins", "losses", "win_pct"])


def first_five_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: the first five transactions of each supplier over all its documents:
    five of each document are candidates (they are sorted inside), the least
    five of those are the answer."""
    t = rs.transactions_docs(spark, sf_dir)
    x = t.select("supplier", F.explode(F.slice(varr("doc", "$.transactions"), 1, 5)).alias("tx"))
    text = vstr("tx", "$.description")
    x = x.select("supplier", vstr("tx", "$.date").alias("date"), text.alias("description"),
                 vstr("tx", "$.team.displayName").alias("team"),
                 F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)")), lambda n: n.cast("bigint")).alias("n"))
    # order: date, then order, line, part and quantity as numbers, then flag ('R' has no team)
    n = [F.get("n", i) for i in (0, 1, 3, 2)]
    # filtered by its rank as it is, so that Spark limits each group before the shuffle
    w = Window.partitionBy("supplier").orderBy("date", *n, F.coalesce("team", F.lit("Flag R")))
    return x.withColumn("rank", F.row_number().over(w)).where("rank <= 5").select(
        "supplier", (F.col("rank") - 1).cast("int").alias("pos"), "date", "description", "team")


def scoreboard_key_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: top-level keys of the scoreboard documents with the number of days
    whose documents hold them."""
    keys = rs.scoreboard(spark, sf_dir).select("request_date", F.explode(top_keys("doc")).alias("key")).distinct()
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n_days"))


def table_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: one row per loaded table with its number of requests answered (days,
    teams, rosters, summaries), however many documents an answer came in."""
    parts = [
        rs.teams(spark, sf_dir).select(F.lit("teams").alias("table_name"), vstr("team", "$.team.id").alias("k")),
        rs.rosters(spark, sf_dir).select(F.lit("rosters"), F.col("request_team_id")),
        rs.scoreboard(spark, sf_dir).select(F.lit("scoreboard"), F.col("request_date")),
        rs.game_summary(spark, sf_dir).select(F.lit("game_summary"),
                                              F.concat_ws("|", "request_date", "request_event_id")),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.union(p)
    return u.distinct().groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------ O16, V11
def roster_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first roster load without BUILDING players, then a load of
    BUILDING (new) and MACHINERY (changed salary) players, merged on the
    athlete id."""
    r = roster_chain(spark, sf_dir).join(
        load_table(spark, sf_dir, "customer").select(
            F.col("c_custkey").cast("string").alias("athlete_id"), "c_mktsegment"), "athlete_id")
    target = r.where(F.col("c_mktsegment") != "BUILDING")
    source = r.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")) \
        .withColumn("salary", F.round(F.col("salary") + 100, 2))
    return upsert(target, source, ["athlete_id"]).select(
        "team_id", "athlete_id", F.col("c_mktsegment").alias("segment"), "salary")


def latest_event_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended loads of scoreboard events -- all events, then a
    re-fetch of the final ones with a corrected total -- reduced to the newest
    copy per event."""
    ev = rs.scoreboard_events(spark, sf_dir).select(
        vstr("event", "$.uid").alias("uid"),
        vstr("event", "$.status.type.name").alias("status"),
        vdouble("event", "$.total").alias("total"))
    load1 = ev.withColumn("load_id", F.lit("load-1")) \
        .withColumn("ingested_at", F.lit(dt.datetime(2025, 1, 1, 8, 0)))
    load2 = ev.where(F.col("status") == "STATUS_FINAL") \
        .withColumn("total", F.col("total") + 1.0) \
        .withColumn("load_id", F.lit("load-2")) \
        .withColumn("ingested_at", F.lit(dt.datetime(2025, 1, 2, 8, 0)))
    snap = latest(load1.unionByName(load2), ["uid"], "ingested_at", ["load_id"])
    return snap.select("uid", "status", F.round("total", 2).alias("total"), "load_id")


# ------------------------------------------------------------ O17, O18
def _board_tables(spark: SparkSession, sf_dir: str, depth):
    from docloom.operators.flatten import flatten
    from docloom.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    b = rs.board(spark, sf_dir)
    return flatten(b, "scoreboard", ["request_date", "page"], "doc", max_depth=depth,
                   keep=["request_date", "page"], materialize=True)


def flatten_events_depth1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O17 at depth 1: the events child table of the scoreboard documents."""
    t = _board_tables(spark, sf_dir, 1)["scoreboard__events"]
    return t.select("_row_id", "_parent_id", "_list_idx", "id", "status__type__name", "date",
                    F.col("competitions").isNotNull().alias("has_competitions"))


def flatten_competitors_depth3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O17 at depth 3: competitors, three array hops below the document."""
    t = _board_tables(spark, sf_dir, 3)["scoreboard__events__competitions__competitors"]
    return t.select("_root_id", "_parent_id", "_list_idx", "id", "homeAway", "score",
                    "team__displayName")


def flatten_table_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O17 with no cap: every table the scoreboard documents produce, with
    its row count and column count."""
    tables = _board_tables(spark, sf_dir, None)
    parts = [df.select(F.lit(n).alias("table_name"), F.lit(len(df.columns)).alias("n_columns"))
             for n, df in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("table_name", "n_columns").agg(F.count(F.lit(1)).alias("n_rows"))
