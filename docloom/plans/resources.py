"""The four resources (and the documented extra sets) as parsed, stamped
document DataFrames, built from the driver tables.

Each returns ``resource, request_<key>..., page, doc, ingested_at, <key>...``
where ``doc`` is VARIANT, ``request_<key>`` is the request context (the landing
folder value: used to prune and to chain) and ``<key>`` is the stamped value
(the payload's own key wins, O5).  Context keys per resource: scoreboard
``date``; teams none; rosters ``team_id``; game_summary ``date``, ``event_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.json import parse_doc
from docloom.operators.chain import chain
from docloom.operators.nested import extract_keys, parse_documents, path_rows, stamp
from docloom.sources import fixtures as fx
from docloom.sources.landing import once

TEAMS_PATH = "$.sports[0].leagues[0].teams"


def _parsed(df: DataFrame, context: list[str]) -> DataFrame:
    for k in context:
        df = df.withColumnRenamed(k, f"request_{k}")
    p = parse_documents(df, "body", "doc")
    return stamp(p, "doc", {k: F.col(f"request_{k}") for k in context}).drop("body")


def scoreboard(spark: SparkSession, sf_dir: str, day=None) -> DataFrame:
    """``day`` limits the documents to one day before they are built."""
    return _parsed(fx.day_docs(spark, sf_dir, day=day), ["date"])


def board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(fx.board_docs(spark, sf_dir), ["date"])


def teams_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(fx.group_docs(spark, sf_dir), [])


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per team of the first sport's first league."""
    return path_rows(teams_docs(spark, sf_dir), TEAMS_PATH, "doc", "team")


def roster_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(fx.roster_docs(spark, sf_dir), ["team_id"])


def summary_docs(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    return _parsed(fx.event_docs(spark, sf_dir, only=only), ["event_id"])


def standings_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(fx.stat_docs(spark, sf_dir), [])


def transactions_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(fx.tx_docs(spark, sf_dir), [])


def team_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O6 on teams: truthy ``team.id`` values, in team order, duplicates kept."""
    return extract_keys(teams(spark, sf_dir), "team", "$.team.id", "team_id").select("team_id")


def rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rosters of the teams listed by the teams resource, stamped with the
    team id they were requested for."""
    r = chain(team_ids(spark, sf_dir), roster_docs(spark, sf_dir).drop("team_id", "ingested_at"),
              "team_id", "request_team_id")
    return stamp(r.withColumnRenamed("team_id", "request_team_id"), "doc",
                 {"team_id": F.col("request_team_id")})


def scoreboard_events(spark: SparkSession, sf_dir: str, pos: bool = False) -> DataFrame:
    """O7 (+O10): one row per event entry of each scoreboard document."""
    return path_rows(scoreboard(spark, sf_dir), "$.events", "doc", "event", pos="pos" if pos else None)


def event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O6 on scoreboard events: truthy ids with their day (no dedup)."""
    return extract_keys(scoreboard_events(spark, sf_dir), "event", "$.id", "event_id") \
        .select(F.col("request_date").alias("date"), "event_id")


def game_summary(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """Summaries of the events listed by each day's scoreboard, stamped
    with the day and the event id they were requested for.  ``ids`` are the
    ``event_ids`` where the caller has them already.  Bodies are parsed behind the join,
    so those that no day lists are not."""
    s = fx.event_docs(spark, sf_dir)
    g = chain(event_ids(spark, sf_dir) if ids is None else ids, s, "event_id")
    g = once(g, "doc", parse_doc("body")).drop("body")
    g = g.withColumnRenamed("date", "request_date").withColumnRenamed("event_id", "request_event_id")
    return stamp(g, "doc", {"date": F.col("request_date"), "event_id": F.col("request_event_id")})


def news_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(fx.news_docs(spark, sf_dir), [])
