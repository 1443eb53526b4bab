"""Date helpers: inclusive day ranges, seasons, request dates, user dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the season calendar: a season named Y runs from October 1
# of Y-1 to June 30 of Y (both kept).
SEASON_START_MONTH, SEASON_START_DAY = 10, 1
SEASON_END_MONTH, SEASON_END_DAY = 6, 30


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def compact_date(d) -> Column:
    """DATE/TIMESTAMP -> 'yyyyMMdd' request text."""
    return F.date_format(_c(d), "yyyyMMdd")


def date_range(start, end) -> Column:
    """Inclusive ARRAY<DATE> from start to end; empty when start > end or
    either bound is NULL (``sequence`` would raise or count down)."""
    s, e = F.to_date(_c(start)), F.to_date(_c(end))
    return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 DAY"))) \
        .otherwise(F.array().cast("array<date>"))


def season_end_year(d) -> Column:
    """Season of a day, named by the year it ends; NULL for July-September,
    which belongs to no season."""
    d = F.to_date(_c(d))
    m = F.month(d)
    return F.when(m >= SEASON_START_MONTH, F.year(d) + 1) \
        .when(m <= SEASON_END_MONTH, F.year(d))


def season_bounds(season, start=None, end=None) -> tuple[Column, Column]:
    """Resolve a (start, end) window from a season and optional bounds.

    * both given: unchanged
    * only start: end = start, unless start is the season's first day, then
      the season's last day
    * only end: start = the season's first day
    * none: the whole season
    """
    season = _c(season)
    s_first = F.make_date(season - 1, F.lit(SEASON_START_MONTH), F.lit(SEASON_START_DAY))
    s_last = F.make_date(season, F.lit(SEASON_END_MONTH), F.lit(SEASON_END_DAY))
    st = F.to_date(_c(start)) if start is not None else F.lit(None).cast("date")
    en = F.to_date(_c(end)) if end is not None else F.lit(None).cast("date")
    r_start = F.coalesce(st, s_first)
    r_end = F.when(en.isNotNull(), en) \
        .when(r_start == s_first, s_last) \
        .otherwise(r_start)
    return r_start, r_end


# Fixed value: the two instant forms the API sends (with / without seconds).
ISO_INSTANT = r"^(\d{4})-(\d{2})-(\d{2})T(\d{2}):(\d{2})(?::(\d{2}))?Z$"


def parse_iso_instant(text) -> Column:
    """UTC ISO-8601 text with or without seconds ('2024-10-25T23:00Z',
    '2024-10-25T20:00:00Z') -> TIMESTAMP_NTZ in UTC; anything else -> NULL.
    Built from the parts, so the session time zone plays no part."""
    t = _c(text)
    part = lambda i: F.regexp_extract(t, ISO_INSTANT, i).try_cast("int")
    sec = F.coalesce(part(6), F.lit(0))
    return F.when(t.rlike(ISO_INSTANT), F.try_make_timestamp_ntz(
        part(1), part(2), part(3), part(4), part(5), sec.cast("decimal(8,6)")))


def parse_user_date(text) -> Column:
    """'yyyy-MM-dd' or 'yyyyMMdd' -> DATE; anything else -> NULL."""
    t = F.trim(_c(text))
    return F.coalesce(F.try_to_date(t, "yyyy-MM-dd"), F.try_to_date(t, "yyyyMMdd"))
