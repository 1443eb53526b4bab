"""Name -> query callable, and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docloom.plans import queries as q
from docloom.plans import loads as ld
from docloom.plans import views as v

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # requests side
    "order_calendar": q.order_calendar,
    "ship_window_days": q.ship_window_days,
    "season_summary": q.season_summary,
    "season_window_cases": q.season_window_cases,
    "season_1998_orders": q.season_1998_orders,
    "event_windows": q.event_windows,
    "request_manifest": q.request_manifest,
    "resource_filter": q.resource_filter,
    "date_text_validation": q.date_text_validation,
    # documents
    "props_values": q.props_values,
    "scoreboard_event_rows": q.scoreboard_event_rows,
    "teams_by_path": q.teams_by_path,
    "stamp_precedence": q.stamp_precedence,
    "truthy_event_ids": q.truthy_event_ids,
    "event_positions": q.event_positions,
    "status_event_positions": q.status_event_positions,
    "nth_event_ids": q.nth_event_ids,
    # chains
    "roster_chain": q.roster_chain,
    "summary_chain": q.summary_chain,
    "missing_summaries": q.missing_summaries,
    "skipped_days": q.skipped_days,
    # documented queries
    "games_of_day": q.games_of_day,
    "first_event_summary": q.first_event_summary,
    "home_away_board": q.home_away_board,
    "home_away_of_day": q.home_away_of_day,
    "standings_key_stats": q.standings_key_stats,
    "first_five_transactions": q.first_five_transactions,
    "scoreboard_key_census": q.scoreboard_key_census,
    "table_census": q.table_census,
    "event_path_census": q.event_path_census,
    # flattening
    "flatten_events_depth1": q.flatten_events_depth1,
    "flatten_competitors_depth3": q.flatten_competitors_depth3,
    "flatten_table_sizes": q.flatten_table_sizes,
    # typed views
    "games": v.games,
    "competitors": v.competitors,
    "linescores": v.linescores,
    "team_box": v.team_box,
    "player_box": v.player_box,
    "player_stats_kv": v.player_stats_kv,
    "player_stats_list": v.player_stats_list,
    "roster_players": v.roster_players,
    "player_injuries": v.player_injuries,
    "player_contracts": v.player_contracts,
    "venues": v.venues,
    "transactions": v.transactions,
    "standings": v.standings,
    "officials": v.officials,
    "articles": v.articles,
    # loads
    "roster_upsert": q.roster_upsert,
    "latest_event_snapshot": q.latest_event_snapshot,
    "append_rerun_load": ld.append_rerun_load,
    "replace_teams_load": ld.replace_teams_load,
    "merge_rosters_load": ld.merge_rosters_load,
    "load_run_report": ld.load_run_report,
    "season_run_tables": ld.season_run_tables,
    "failed_run_recovery": ld.failed_run_recovery,
    "schema_over_loads": ld.schema_over_loads,
    "rejected_documents": ld.rejected_documents,
    # streaming
    "incremental_scoreboard_load": ld.incremental_scoreboard_load,
}


def oracle() -> dict[str, str]:
    from docloom.plans.oracle import SQL
    return {k: v for k, v in SQL.items() if k in QUERIES}
