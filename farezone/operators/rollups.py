"""Rollups: daily -> monthly with grouping sets (A13, A14); ALL and final sums."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame

from farezone import config as C
from farezone.functions.text import literal, sql
from farezone.operators.filters import before_period_start, company_in, drop_null_key, is_not_company, is_since

MART_KEYS = ("year_month", "id", "company", "Z", "Zone", "metric")


def daily_to_monthly(daily: DataFrame, end: int) -> DataFrame:
    """A13 + A14: monthly trips per sub-industry and their total, in one pass.

    ``GROUPING SETS ((month, industry), (month))``: the total rows are labelled
    ``fhv``. Every row carries the constant id 999.
    """
    d = before_period_start(company_in(daily, C.FHV_SUBINDUSTRIES, col="industry"), end)
    month = "trunc(CAST(metric_day AS date), 'month')"  # P4
    return sql(d, f"""
        SELECT year_month, CAST({C.FHV_TOTAL_ID} AS int) AS id, CAST(sum(count_trips) AS bigint) AS count,
               CASE WHEN grouping(industry) = 1 THEN {literal(C.FHV_TOTAL_LABEL)} ELSE industry END AS industry
        FROM (SELECT {month} AS year_month, industry, count_trips FROM {{df}})
        GROUP BY GROUPING SETS ((year_month, industry), (year_month))""")


def counts_for_all(since: _dt.date) -> str:
    """F11 + F12 (SQL text): the rows that the ALL rollup takes, months from ``since``, SHARED left out."""
    return f"{is_since(since)} AND {is_not_company(C.ALL_EXCLUDED)}"


def all_companies(df: DataFrame, since: _dt.date, keys=("year_month", "id", "Z", "Zone", "metric"),
                  value: str = "count") -> DataFrame:
    """The ``ALL`` row per key -- sum over companies except SHARED, from ``since``.

    Rows with a NULL key (e.g. an id without a zone name) are left out.
    """
    by = ", ".join(keys)
    return sql(drop_null_key(df.filter(counts_for_all(since)), *keys), f"""
        SELECT {by}, sum({value}) AS {value}, {literal(C.ALL_LABEL)} AS company FROM {{df}} GROUP BY {by}""")


def final_sum(df: DataFrame, keys=MART_KEYS, value: str = "count") -> DataFrame:
    """Sum by the mart keys; rows with a NULL key vanish (pandas group-by)."""
    by = ", ".join(keys)
    return sql(drop_null_key(df, *keys), f"SELECT {by}, sum({value}) AS {value} FROM {{df}} GROUP BY {by}")
