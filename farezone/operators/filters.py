"""Filters and predicates.

Filters on raw scan columns (hour key, measures, route id) are plain comparisons,
so Catalyst pushes them into the Parquet reader (``PushedFilters``) and row groups
are skipped by their min/max statistics.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame

from farezone.config import Industry
from farezone.functions.text import literal
from farezone.functions.timekeys import run_bounds


def in_period(df: DataFrame, start: int, end: int, col: str = "datetimeid") -> DataFrame:
    """half-open range on the raw hour key (pushable; never on ``div 10000``)."""
    return df.filter(f"{col} >= {literal(start)} AND {col} < {literal(end)}")


def valid_trip(df: DataFrame, industry: Industry) -> DataFrame:
    """positive distance and fare; a NULL measure drops the row."""
    if not industry.has_measures:
        return df
    return df.filter(f"{industry.distance} > 0 AND {industry.fare} > 0")


def within_caps(df: DataFrame, industry: Industry, fare_cap, distance_cap,
                time_cap_secs: int | None = None) -> DataFrame:
    """outlier caps on fare and distance, and optionally ``0 < seconds < cap``."""
    caps = f"{industry.fare} < {literal(fare_cap)} AND {industry.distance} < {literal(distance_cap)}"
    if time_cap_secs is not None:
        caps += f" AND {industry.seconds} > 0 AND {industry.seconds} < {literal(time_cap_secs)}"
    return df.filter(caps)


def shared_only(df: DataFrame) -> DataFrame:
    """shared rides carry a route id."""
    return df.filter("route_id IS NOT NULL")


def company_not_in(df: DataFrame, names, col: str = "company") -> DataFrame:
    """SQL ``NOT IN`` -- a NULL company is dropped (three-valued logic)."""
    return df.filter(f"{col} NOT IN ({', '.join(map(literal, names))})")


def company_in(df: DataFrame, names, col: str = "company") -> DataFrame:
    """SQL ``IN`` list."""
    return df.filter(f"{col} IN ({', '.join(map(literal, names))})")


def drop_null_key(df: DataFrame, *keys: str) -> DataFrame:
    """drop rows with a NULL key before grouping (pandas group-by semantics)."""
    return df.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys))


def before_month(df: DataFrame, asof: _dt.date, col: str = "year_month") -> DataFrame:
    """complete months only -- strictly before the month before ``asof``'s."""
    last_month, _ = run_bounds(asof)
    return df.filter(f"{col} < DATE '{last_month}'")


def is_since(since: _dt.date, col: str = "year_month") -> str:
    """F11 as a condition (SQL text): ``year_month >= since``."""
    return f"{col} >= DATE '{since}'"


def since_month(df: DataFrame, since: _dt.date, col: str = "year_month") -> DataFrame:
    """``year_month >= since``."""
    return df.filter(is_since(since, col))


def is_not_company(names, col: str = "company") -> str:
    """F12 as a condition (SQL text): not one of the names; a NULL company is none (pandas ``~isin``)."""
    return f"coalesce({col} NOT IN ({', '.join(map(literal, names))}), true)"


def exclude_company(df: DataFrame, names, col: str = "company") -> DataFrame:
    """drop the named companies but keep a NULL company."""
    return df.filter(is_not_company(names, col))


def before_period_start(df: DataFrame, end: int, col: str = "period_start") -> DataFrame:
    """``period_start < end`` on the daily table."""
    return df.filter(f"{col} < {literal(end)}")
