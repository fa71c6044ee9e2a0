"""Time helpers. Everything is TIMESTAMP_NTZ (wall clock), so results never depend on the
session time zone; the epoch conversions read the wall clock as UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"


def ts_literal(value: dt.datetime | dt.date | str) -> Column:
    """A constant TIMESTAMP_NTZ (folded by Catalyst, so it can be pushed to the scan)."""
    if isinstance(value, dt.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = value
    return F.lit(text).cast("timestamp_ntz")


def year_start(year: int) -> Column:
    return ts_literal(dt.datetime(year, 1, 1))


def in_year(c: str | Column, year: int) -> Column:
    """``year(c) = year`` written as a half-open range, which parquet can use for row-group skipping."""
    col = F.col(c) if isinstance(c, str) else c
    return (col >= year_start(year)) & (col < year_start(year + 1))


def load_date_of(c: str | Column) -> Column:
    """The run date of the yearly batch a row belongs to: 1 January of its year, 00:00."""
    col = F.col(c) if isinstance(c, str) else c
    return F.make_timestamp_ntz(F.year(col), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def ts_to_epoch_ms(c: str | Column) -> Column:
    """Milliseconds since 1970-01-01 of a wall-clock timestamp (fraction below 1 ms truncated)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("MILLISECOND", F.lit(_EPOCH).cast("timestamp_ntz"), col)


def epoch_ms_to_ts(c: str | Column) -> Column:
    """Exact inverse of ``ts_to_epoch_ms`` for whole milliseconds (long arithmetic)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.timestamp_add("MILLISECOND", col.cast("long"), F.lit(_EPOCH).cast("timestamp_ntz"))
