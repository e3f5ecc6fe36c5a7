"""Time keys (P1-P5): integer hour keys YYYYMMDDHH, month keys YYYYMM, dates.

All are built-in column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Timestamp -> YYYYMMDDHH as bigint, as SQL text of a column to fill in.
HOUR_KEY = "(CAST(year({0}) AS bigint) * 1000000 + month({0}) * 10000 + dayofmonth({0}) * 100 + hour({0}))"


def hour_key(ts: str) -> Column:
    """Timestamp -> YYYYMMDDHH as bigint, computed numerically (no string format)."""
    return F.expr(HOUR_KEY.format(ts))


#: P1 as SQL text, on the trips' hour key.
MONTH_KEY = "(datetimeid div 10000)"


def month_key(datetimeid: str = "datetimeid") -> Column:
    """YYYYMMDDHH -> YYYYMM with integral ``div`` (``/`` would give a double)."""
    return F.expr(f"`{datetimeid}` div 10000")


def month_date(ym: str) -> Column:
    """YYYYMM (bigint) -> first-of-month date."""
    return F.expr(f"make_date(CAST({ym} / 100 AS int), CAST(pmod({ym}, 100) AS int), 1)")


def as_date(c) -> Column:
    """Timestamp -> date."""
    return _col(c).cast("date")


def month_trunc(c) -> Column:
    """First day of the month of a date or timestamp, as a date."""
    return F.trunc(_col(c).cast("date"), "month")


def month_start(d: _dt.date) -> _dt.date:
    return d.replace(day=1)


def add_months(d: _dt.date, n: int) -> _dt.date:
    m = d.year * 12 + (d.month - 1) + n
    return _dt.date(m // 12, m % 12 + 1, 1)


def encode_hour_key(d: _dt.date) -> int:
    """A date at 00h as the integer hour key YYYYMMDDHH."""
    return int(d.strftime("%Y%m%d")) * 100


def run_bounds(asof: _dt.date) -> tuple[_dt.date, int]:
    """P5: the last complete month for a run on ``asof``.

    Returns ``(last_month, end)``: the first day of the month before ``asof``'s
    month, and the same date as an hour key. Published rows are strictly before
    ``last_month``; fare queries read hour keys strictly below ``end``.
    """
    last_month = add_months(month_start(asof), -1)
    return last_month, encode_hour_key(last_month)
