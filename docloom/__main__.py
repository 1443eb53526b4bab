"""Job entry point: ``spark-submit -m docloom`` / ``python -m docloom``.

Maps the reference's run modes onto one ``run_load`` call over landed
documents; all data work happens in Spark.

  --date D                      one day (all four resources unless --tables)
  --backfill Y [--start --end]  season Y, bounds resolved as the season window
                                (all four resources unless --tables)
  --season-schedule Y           season Y, scoreboard only
  --reference                   teams and rosters only
  --all                         season 2025, all four resources
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from docloom.operators.requests import RESOURCES, normalize_names, unknown_resources

DEFAULT_SEASON = 2025


def _day(text: str, field: str) -> dt.date:
    t = text.strip()
    for fmt in ("%Y-%m-%d", "%Y%m%d"):
        try:
            return dt.datetime.strptime(t, fmt).date()
        except ValueError:
            pass
    raise SystemExit(f"invalid {field}: {text!r}; expected YYYY-MM-DD")


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="docloom", description="Load landed documents into tables.")
    mode = p.add_mutually_exclusive_group(required=True)
    mode.add_argument("--date")
    mode.add_argument("--backfill", type=int, metavar="SEASON")
    mode.add_argument("--season-schedule", type=int, metavar="SEASON")
    mode.add_argument("--reference", action="store_true")
    mode.add_argument("--all", action="store_true")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--tables", help="comma-separated: " + ",".join(RESOURCES))
    p.add_argument("--depth", type=int, default=None, help="flatten depth cap")
    p.add_argument("--landing", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--load-id", required=True)
    p.add_argument("--month-bucket", default=None, help="landing folder level holding yyyyMM")
    return p


def run_arguments(argv: list[str]) -> dict:
    """Parsed command line -> keyword arguments of ``run_load``."""
    a = build_parser().parse_args(argv)
    tables = None if not a.tables else [t for t in a.tables.split(",")]
    if tables is not None:
        if not all(t.strip() for t in tables):
            raise SystemExit(f"an empty name in {a.tables!r}; available: {', '.join(sorted(RESOURCES))}")
        bad = unknown_resources(tables)
        if bad:
            raise SystemExit(f"unknown tables: {', '.join(bad)}; available: {', '.join(sorted(RESOURCES))}")
    kw = dict(landing=a.landing, out_root=a.out, load_id=a.load_id, max_depth=a.depth,
              month_bucket=a.month_bucket)
    if a.date:
        d = _day(a.date, "date")
        kw.update(season=DEFAULT_SEASON, start=d, end=d, tables=tables)
    elif a.backfill is not None or a.season_schedule is not None:
        season = a.backfill if a.backfill is not None else a.season_schedule
        if not season:
            raise SystemExit("a season year is required")
        start = _day(a.start, "start") if a.start else None
        end = _day(a.end, "end") if a.end else None
        if a.season_schedule is not None:
            if tables is not None and "scoreboard" not in (normalize_names(tables) or set()):
                print("warning: --tables excludes the schedule; loading it anyway", file=sys.stderr)
            if start or end:
                print("warning: a season schedule is the whole season; --start and --end are ignored", file=sys.stderr)
                start = end = None
            sel = ["scoreboard"]
        else:
            sel = tables
        kw.update(season=season, start=start, end=end, tables=sel)
    elif a.reference:
        sel = normalize_names(tables) if tables is not None else {"teams", "rosters"}
        if sel - {"teams", "rosters"}:
            print(f"warning: not reference tables, ignored: {', '.join(sorted(sel - {'teams', 'rosters'}))}",
                  file=sys.stderr)
        kw.update(season=DEFAULT_SEASON, tables=sorted(sel & {"teams", "rosters"}))
    else:
        kw.update(season=DEFAULT_SEASON, tables=tables)
    return kw


def main(argv: list[str] | None = None) -> None:
    kw = run_arguments(sys.argv[1:] if argv is None else argv)
    from docloom.plans.run import run_load
    from docloom.session import get_session
    spark = _active() or get_session()
    landing, out_root, load_id = kw.pop("landing"), kw.pop("out_root"), kw.pop("load_id")
    written = run_load(spark, landing, out_root, load_id, **kw)
    print(json.dumps({"load_id": load_id, "tables": written}))


def _active():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


if __name__ == "__main__":
    main()
