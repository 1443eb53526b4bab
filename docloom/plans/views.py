"""Typed views over the landed documents (V1-V10).  The reference lands these
shapes raw; the views are what a Spark user queries.  All per-row work is
done inside the row -- no shuffle except where a view really groups (venues).
An array is read once, typed by the fields the view names (``path_rows(of=...)``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.dates import parse_iso_instant
from docloom.functions.json import vdouble, vlong, vstr
from docloom.functions.stats import clock_seconds, made_attempted, plain_number, signed_int
from docloom.operators.nested import path_rows
from docloom.operators.pairs import name_value_columns
from docloom.plans import resources as rs

# Status type id -> game state.
STATE_BY_STATUS_ID = {"1": "pre", "2": "in", "3": "post"}
LOCAL_ZONE = "America/New_York"


def games(spark: SparkSession, sf_dir: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """V1: one row per scoreboard event: uid parts, state decoded from the
    status id, start time in UTC and in a local zone, and its first
    competition's id, date, flags and venue."""
    ev = path_rows(rs.scoreboard(spark, sf_dir), "$.events", "doc", "event", of="""struct<uid:string, date:string,
        status:struct<type:struct<id:string, completed:boolean>>, competitions:array<struct<id:string, date:string,
        neutralSite:boolean, conferenceCompetition:boolean, venue:struct<fullName:string>>>>""")
    uid = F.str_to_map("event.uid", F.lit("~"), F.lit(":"))
    state = F.create_map(*[x for k, v in STATE_BY_STATUS_ID.items() for x in (F.lit(k), F.lit(v))])
    start = parse_iso_instant(F.col("event.date"))
    first = F.get("event.competitions", 0)
    return ev.select(
        F.col("event.uid").alias("uid"),
        uid["s"].alias("sport_id"), uid["l"].alias("league_id"), uid["e"].alias("event_ref"),
        state[F.col("event.status.type.id")].alias("state"),
        F.col("event.status.type.completed").alias("completed"),
        F.date_format(start, "yyyy-MM-dd HH:mm").alias("start_utc"),
        F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), start),
                      "yyyy-MM-dd HH:mm").alias("start_local"),
        first["id"].alias("competition_id"),
        F.date_format(parse_iso_instant(first["date"]), "yyyy-MM-dd HH:mm:ss").alias("competition_utc"),
        first["neutralSite"].alias("neutral_site"),
        first["conferenceCompetition"].alias("conference"),
        first["venue"]["fullName"].alias("venue"))


def _competitors(spark, sf_dir, of: str) -> DataFrame:
    """Competitors ``c`` (of the type ``of``) of each event's first competition."""
    ev = path_rows(rs.board(spark, sf_dir), "$.events", "doc", "event",
                   of=f"struct<id:string, competitions:array<struct<competitors:array<{of}>>>>")
    return ev.select(F.col("event.id").alias("event_id"),
                     F.explode(F.get("event.competitions", 0)["competitors"]).alias("c"))


def competitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: one row per competitor of each game; score text -> int."""
    c = _competitors(spark, sf_dir, "struct<id:string, homeAway:string, score:string, team:struct<displayName:string>>")
    return c.select("event_id", F.col("c.id").alias("competitor_id"),
                    F.col("c.homeAway").alias("home_away"),
                    F.col("c.score").try_cast("int").alias("score"),
                    F.col("c.team.displayName").alias("team_name"))


def linescores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: periods of each competitor by position (period = position + 1)."""
    c = _competitors(spark, sf_dir, "struct<id:string, homeAway:string, linescores:array<struct<value:bigint>>>")
    c = c.select("event_id", F.col("c.id").alias("competitor_id"), F.col("c.homeAway").alias("home_away"),
                 F.posexplode("c.linescores").alias("pos", "ls"))
    return c.select("event_id", "competitor_id", "home_away", (F.col("pos") + 1).cast("int").alias("period"),
                    F.col("ls.value").alias("value"))


def team_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: team statistics of each event, added up over its documents:
    'made-attempted' text is split into two numbers, any other number (decimal
    or negative too) is the value."""
    t = path_rows(rs.summary_docs(spark, sf_dir), "$.boxscore.teams", "doc", "t", of="""struct<
        team:struct<abbreviation:string>, statistics:array<struct<name:string, displayValue:string>>>""")
    s = t.select(F.col("request_event_id").alias("event_id"), F.col("t.team.abbreviation").alias("team"),
                 F.explode("t.statistics").alias("s"))
    made, att = made_attempted(F.col("s.displayValue"))
    s = s.select("event_id", "team", F.col("s.name").alias("stat_name"),
                 made.alias("made"), att.alias("attempted"), plain_number(F.col("s.displayValue")).alias("value"))
    return s.groupBy("event_id", "team", "stat_name").agg(
        F.sum("made").alias("made"), F.sum("attempted").alias("attempted"), F.round(F.sum("value"), 2).alias("value"))


def _athletes(spark, sf_dir) -> DataFrame:
    """One row per athlete of every side and statistics group; only the labels
    travel with it, not the group."""
    p = path_rows(rs.summary_docs(spark, sf_dir).select(F.col("request_event_id").alias("event_id"), "doc"),
                  "$.boxscore.players", "doc", "p", of="""struct<side:string, statistics:array<struct<
                  labels:array<string>, athletes:array<struct<athlete:struct<id:string>, stats:array<string>>>>>>""")
    g = p.select("event_id", F.col("p.side").alias("side"), F.explode("p.statistics").alias("g"))
    a = g.select("event_id", "side", F.col("g.labels").alias("labels"), F.explode("g.athletes").alias("a"))
    return a.select("event_id", "side", "labels", F.col("a.athlete.id").alias("athlete_id"), F.col("a.stats").alias("stats"))


def player_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: labels zipped with each athlete's stats, of both sides; where one of
    the two is shorter the other's entries come with NULL (a map would raise)."""
    a = _athletes(spark, sf_dir)
    return a.select("event_id", "side", "athlete_id",
                    F.inline(F.arrays_zip(F.col("labels").alias("label"), F.col("stats").alias("value"))))


def player_stats_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 on parallel arrays: one row per athlete with typed stats: points,
    field goals made/attempted, signed plus-minus and minutes as seconds, by
    positional lookup (``get`` gives NULL when a label has no value)."""
    a = _athletes(spark, sf_dir)
    stat = lambda n: F.get("stats", F.array_position("labels", n) - 1)
    made, att = made_attempted(stat("FG"))
    return a.select("event_id", "side", "athlete_id",
                    signed_int(stat("PTS")).alias("pts"),
                    made.alias("fg_made"), att.alias("fg_att"),
                    signed_int(stat("+/-")).alias("plus_minus"),
                    clock_seconds(stat("MIN")).alias("min_seconds"))


def player_stats_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 on the documented name/value list: clock text as seconds, points,
    signed plus-minus; a stat that is not listed is NULL."""
    a = path_rows(rs.summary_docs(spark, sf_dir).select(F.col("request_event_id").alias("event_id"), "doc"),
                  "$.playerStats", "doc", "a", of="""struct<athlete:struct<id:string>, team:struct<displayName:string>,
                  stats:array<struct<name:string, value:string>>>""")
    # looked up once, before the texts are parsed
    a = a.select("event_id", F.col("a.athlete.id").alias("athlete_id"), F.col("a.team.displayName").alias("team"),
                 *name_value_columns(F.col("a.stats"), ["minutes", "points", "plusMinus"], value_type=None))
    return a.select("event_id", "athlete_id", "team", clock_seconds("minutes").alias("min_seconds"),
                    signed_int("points").alias("pts"), signed_int("plusMinus").alias("plus_minus"))


def roster_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: athletes of every roster document with the team id stamped."""
    r = path_rows(rs.roster_docs(spark, sf_dir), "$.athletes", "doc", "a")
    return r.select("team_id", vstr("a", "$.id").alias("athlete_id"),
                    vstr("a", "$.displayName").alias("name"),
                    vstr("a", "$.position.abbreviation").alias("position"),
                    F.round(vdouble("a", "$.salary"), 2).alias("salary"))


def player_injuries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8: injuries, an array inside each athlete."""
    r = path_rows(path_rows(rs.roster_docs(spark, sf_dir), "$.athletes", "doc", "a"),
                  "$.injuries", "a", "i")
    return r.select("team_id", vstr("a", "$.id").alias("athlete_id"),
                    vstr("i", "$.status").alias("status"), vstr("i", "$.type").alias("type"))


def player_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8: contracts, an array inside each athlete."""
    r = path_rows(path_rows(rs.roster_docs(spark, sf_dir), "$.athletes", "doc", "a"),
                  "$.contracts", "a", "c")
    return r.select(vstr("a", "$.id").alias("athlete_id"),
                    vlong("c", "$.season").cast("int").alias("season"),
                    F.round(vdouble("c", "$.salary"), 2).alias("salary"))


def venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: distinct venues with the number of games played there."""
    ev = path_rows(rs.board(spark, sf_dir), "$.events", "doc", "event",
                   of="struct<id:string, competitions:array<struct<venue:struct<fullName:string>>>>")
    v = ev.select(F.get("event.competitions", 0)["venue"]["fullName"].alias("venue"),
                  F.col("event.id").alias("event_id")).where(F.col("venue").isNotNull())
    return v.groupBy("venue").agg(F.count_distinct("event_id").alias("n_games"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction; the team is optional."""
    t = path_rows(rs.transactions_docs(spark, sf_dir), "$.transactions", "doc", "tx")
    return t.select("supplier", vstr("tx", "$.date").alias("date"),
                    vstr("tx", "$.description").alias("description"),
                    vstr("tx", "$.team.displayName").alias("team"))


def standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standings entries of all child groups, one row per stat."""
    g = path_rows(rs.standings_docs(spark, sf_dir).select("doc"), "$.children", "doc", "g")
    e = path_rows(g.select(vstr("g", "$.name").alias("group_name"), "g"), "$.standings.entries", "g", "e")
    s = path_rows(e.select("group_name", "e"), "$.stats", "e", "s")
    return s.select("group_name", vstr("e", "$.team.id").alias("team_id"), vstr("s", "$.name").alias("stat_name"),
                    vdouble("s", "$.value").alias("value"))


def officials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: officials of each game (game info array)."""
    o = path_rows(rs.summary_docs(spark, sf_dir), "$.gameInfo.officials", "doc", "o",
                  of="struct<displayName:string, `order`:bigint>")
    return o.select(F.col("request_event_id").alias("event_id"),
                    F.col("o.displayName").alias("official"),
                    F.col("o.order").cast("int").alias("position"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News articles; the whole description text is kept (its md5 is
    reported here to keep the check small)."""
    a = path_rows(rs.news_docs(spark, sf_dir), "$.articles", "doc", "a")
    return a.select(vstr("a", "$.id").alias("article_id"),
                    vstr("a", "$.headline").alias("headline"),
                    vstr("a", "$.categories[0].description").alias("lang"),
                    F.md5(vstr("a", "$.description")).alias("text_md5"))
