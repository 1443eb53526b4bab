import datetime as dt

import pytest

from docloom.__main__ import run_arguments

BASE = ["--landing", "L", "--out", "O", "--load-id", "x"]


def test_date_mode():
    kw = run_arguments(["--date", "2024-12-25", "--tables", "scoreboard, game_summary"] + BASE)
    assert kw["start"] == kw["end"] == dt.date(2024, 12, 25)
    assert kw["tables"] == ["scoreboard", " game_summary"]
    assert run_arguments(["--date", "2024-12-25"] + BASE)["tables"] is None   # all four


def test_empty_tables_means_no_filter():
    assert run_arguments(["--all", "--tables", ""] + BASE)["tables"] is None


def test_backfill_and_schedule():
    kw = run_arguments(["--backfill", "2025", "--start", "2024-10-29", "--end", "2024-10-31"] + BASE)
    assert (kw["season"], kw["start"], kw["end"]) == (2025, dt.date(2024, 10, 29), dt.date(2024, 10, 31))
    kw = run_arguments(["--season-schedule", "2025", "--tables", "teams"] + BASE)
    assert kw["tables"] == ["scoreboard"] and kw["start"] is None


def test_reference_mode_keeps_reference_tables_only():
    assert run_arguments(["--reference"] + BASE)["tables"] == ["rosters", "teams"]
    assert run_arguments(["--reference", "--tables", "teams,scoreboard"] + BASE)["tables"] == ["teams"]


@pytest.mark.parametrize("argv", [["--date", "12/25/2024"], ["--all", "--tables", "bogus"],
                                  ["--backfill", "0"], []])
def test_errors(argv):
    with pytest.raises(SystemExit):
        run_arguments(argv + BASE)


@pytest.mark.parametrize("names", [",", "scoreboard,", " ,teams"])
def test_empty_names_are_an_error(names):
    with pytest.raises(SystemExit):
        run_arguments(["--all", "--tables", names] + BASE)


def test_schedule_is_the_whole_season_and_warns(capsys):
    kw = run_arguments(["--season-schedule", "2025", "--start", "2024-10-29", "--end", "2024-10-31"] + BASE)
    assert kw["start"] is None and kw["end"] is None
    assert "ignored" in capsys.readouterr().err


def test_reference_mode_warns_of_ignored_tables(capsys):
    run_arguments(["--reference", "--tables", "teams,scoreboard"] + BASE)
    assert "scoreboard" in capsys.readouterr().err
