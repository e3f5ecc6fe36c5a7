"""Pipeline C: monthly fare tables, wide and long."""

from __future__ import annotations

from pyspark.sql import DataFrame

from farezone.config import Params
from farezone.functions.timekeys import month_date, run_bounds
from farezone.operators.fares import fare_trips, monthly_fares
from farezone.operators.reshape import to_long
from farezone.plans.inputs import TripInputs

# industry name -> trip table it reads
FARE_SOURCES = {"yellow": "yellow", "green": "green", "hvfhv": "hvfhv", "shared": "hvfhv"}


def fares_wide(inputs: TripInputs, params: Params, industry: str) -> DataFrame:
    """A8-A11 for one industry up to the run bound, with ``year_month`` as a date."""
    ind = params.industry(industry)
    _, end = run_bounds(params.asof)
    t = fare_trips(inputs.trips()[FARE_SOURCES[industry]], ind, ind.fares_start, end,
                   params.fare_cap, params.distance_cap)
    return monthly_fares(t, ind).withColumn("year_month", month_date("year_month"))


def fares_long(wide: DataFrame) -> DataFrame:
    """R2: every measure column -> ``(year_month, variable, value)``."""
    return to_long(wide, ["year_month"], None, "variable", "value")

