"""Stat text found in documents: clocks, signed numbers, made-attempted pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clock_seconds(text) -> Column:
    """'35:45' -> 2145 seconds; NULL unless the text is mm:ss."""
    t = _c(text)
    ok = t.rlike(r"^\d+:\d{2}$")
    return F.when(ok, (F.split_part(t, F.lit(":"), F.lit(1))).try_cast("bigint") * 60
                  + (F.split_part(t, F.lit(":"), F.lit(2))).try_cast("bigint"))


def signed_int(text) -> Column:
    """'+15' -> 15, '-3' -> -3, '12' -> 12, other -> NULL."""
    return (F.trim(_c(text))).try_cast("bigint")


def made_attempted(text) -> tuple[Column, Column]:
    """'45-89' -> (45, 89); '7-' -> (7, NULL); any other text, '-5' too -> NULLs."""
    t = _c(text)
    pair = t.rlike(r"^\d+-\d*$")
    return (F.when(pair, F.split_part(t, F.lit("-"), F.lit(1))).try_cast("bigint"),
            F.when(pair, F.split_part(t, F.lit("-"), F.lit(2))).try_cast("bigint"))


def plain_number(text) -> Column:
    """'50.6' -> 50.6, '-5' -> -5.0, '+3' -> 3.0; a pair or other text -> NULL."""
    return F.trim(_c(text)).try_cast("double")
