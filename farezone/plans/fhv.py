"""Pipeline D: traditional FHV monthly totals (C7) from the daily indicator table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from farezone.config import Params
from farezone.functions.timekeys import run_bounds
from farezone.operators.rollups import daily_to_monthly


def traditional_fhv_totals(daily: DataFrame, params: Params) -> DataFrame:
    """``(year_month, id=999, count, industry)`` per sub-industry plus ``fhv``."""
    _, end = run_bounds(params.asof)
    return daily_to_monthly(daily, end)
