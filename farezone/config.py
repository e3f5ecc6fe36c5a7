"""Declarative configuration: industries, run parameters and fixed label values.

Industry differences (which columns hold distance, fare and time, which filters
apply, where the company comes from) live here, so every operator is written once
and parameterised by an :class:`Industry`.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

from farezone.functions.timekeys import run_bounds

# ---------------------------------------------------------------------------
# Fixed values. These must equal the published dashboard's labels and rules,
# so they are stated as plain text, in their natural order.
# ---------------------------------------------------------------------------

# High-volume licence code -> company name; any other code passes through.
LICENSE_COMPANY = {
    "HV0002": "JUNO",
    "HV0003": "UBER",
    "HV0004": "VIA",
    "HV0005": "LYFT",
}

# Companies of the high-volume sector; relabelled to HVFHV in the trips mart and
# excluded from the traditional-FHV origin/destination counts.
HV_COMPANIES = ("UBER", "LYFT", "JUNO", "VIA")
HV_SECTOR_LABEL = "HVFHV"

# Industry tag of traditional FHV trips and the label it is published under.
TRADITIONAL_TAG = "no_hv"
TRADITIONAL_LABEL = "FHV"

# Companies left out of the ALL rollup (SHARED is a subset of the HV trips).
ALL_EXCLUDED = ("SHARED",)
ALL_LABEL = "ALL"
# Companies dropped from the published trips mart (monthly FHV comes from the
# daily indicator table instead).
MART_EXCLUDED = ("FHV",)

# Zone that holds every taxi zone; it carries the city-wide Trips metric.
CITYWIDE = "Citywide"

# Metric labels of the trips mart.
METRIC_TRIPS = "Trips"
METRIC_PICKUPS = "PickUps"
METRIC_DROPOFFS = "DropOffs"

# Display names of the four zone-financial measures, in published order.
FINANCIAL_METRICS = {
    "avg_total_fare": "Average Fare",
    "sum_total_fare": "Total Fare",
    "avg_trip_time": "Average Trip Time",
    "avg_trip_distance": "Average Trip Distance",
}

# Daily indicator table: the traditional FHV sub-industries, their total's label
# and the constant id the dashboard files them under.
FHV_SUBINDUSTRIES = ("fhv_black_car", "fhv_livery", "fhv_lux_limo")
FHV_TOTAL_LABEL = "fhv"
FHV_TOTAL_ID = 999

# Constant fee columns of the metered fare tables.
MTA_TAX = 0.50
IMPROVEMENT_SURCHARGE = 0.30

# Production defaults: outlier caps and history bounds (hour keys YYYYMMDDHH).
DEFAULT_FARE_CAP = 250
DEFAULT_DISTANCE_CAP = 100
DEFAULT_TIME_CAP_SECS = 7200
PUBLISHED_TRIPS_END = 2022060100
DEFAULT_ALL_SINCE = _dt.date(2017, 6, 1)


# ---------------------------------------------------------------------------
# Industries
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Industry:
    """How one trip table is read and measured."""

    name: str
    distance: str
    fare: str
    seconds: str
    # column holding a company code (hv); None -> the industry name is the company
    company_col: str | None = None
    # keep only shared rides (route_id is not NULL)
    shared_only: bool = False
    # positive-measure filter (trip distance and fare > 0); fhv has no measures
    has_measures: bool = True
    # history start per use (hour key)
    trips_start: int = 0
    financials_start: int = 0
    # 0: up to the run's publication bound
    financials_end: int = 0
    fares_start: int = 0


# The first month of each industry's published history.
METERED = dict(distance="trip_distance", fare="total_amount", seconds="trip_time_in_secs")
HIGH_VOLUME = dict(distance="trip_miles", fare="base_passenger_fare", seconds="trip_time")

YELLOW = Industry("yellow", **METERED, trips_start=2011010100,
                  financials_start=2011010100, fares_start=2011010100)
GREEN = Industry("green", **METERED, trips_start=2014010100,
                 financials_start=2014010100, fares_start=2014010100)
FHV = Industry("no_hv", distance="", fare="", seconds="", has_measures=False,
               trips_start=2015010100)
HVFHV = Industry("hvfhv", **HIGH_VOLUME, company_col="hvfhs_license_num", trips_start=2019020100,
                 financials_start=2019020100, fares_start=2019020100)
SHARED = Industry("shared", **HIGH_VOLUME, shared_only=True, trips_start=2019020100,
                  financials_start=2019020100, fares_start=2019020100)

INDUSTRIES = {i.name: i for i in (YELLOW, GREEN, FHV, HVFHV, SHARED)}


# ---------------------------------------------------------------------------
# Run parameters
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    """Everything a run depends on. ``asof`` replaces "today" so runs repeat.

    Ends that aren't given follow from ``asof``: trips and financials are read up to the
    last month it publishes, so a later run takes in later months by itself
    (``PUBLISHED_TRIPS_END`` is the fixed end that the first published history had).
    """

    asof: _dt.date
    trips_end: int = 0
    all_since: _dt.date = DEFAULT_ALL_SINCE
    fare_cap: float = DEFAULT_FARE_CAP
    distance_cap: float = DEFAULT_DISTANCE_CAP
    time_cap_secs: int = DEFAULT_TIME_CAP_SECS
    # old high-volume counts from the fhv table (before the hv table existed)
    old_hv_start: int = 2017060100
    old_hv_end: int = 2019020100
    # per-industry overrides of the history bounds: name -> Industry
    industries: dict = field(default_factory=lambda: dict(INDUSTRIES))

    def __post_init__(self):
        if not self.trips_end:
            object.__setattr__(self, "trips_end", run_bounds(self.asof)[1])

    def industry(self, name: str) -> Industry:
        return self.industries[name]

    def with_period(self, start: int | None = None, end: int | None = None) -> "Params":
        """Every industry reads hour keys in ``[start, end)`` (trips, zone
        financials; fares from ``start`` up to the run bound) -- for backfills.
        A bound that isn't given stays as it is."""
        def bounded(i: Industry) -> Industry:
            if start is not None:
                i = replace(i, trips_start=start, financials_start=start if i.has_measures else 0,
                            fares_start=start if i.has_measures else 0)
            return i if end is None else replace(i, financials_end=end if i.has_measures else 0)

        industries = {n: bounded(i) for n, i in self.industries.items()}
        return replace(self, trips_end=self.trips_end if end is None else end, industries=industries)


def _hour_key(d: _dt.date) -> int:
    return int(d.strftime("%Y%m%d")) * 100


def since(params: Params, first_month: _dt.date) -> Params:
    """Only months from ``first_month`` on: every industry's start is raised to
    it (an incremental run; earlier months stay as published)."""
    hk = _hour_key(first_month.replace(day=1))
    industries = {
        n: replace(i, trips_start=max(i.trips_start, hk),
                   financials_start=max(i.financials_start, hk) if i.has_measures else 0,
                   fares_start=max(i.fares_start, hk) if i.has_measures else 0)
        for n, i in params.industries.items()
    }
    return replace(params, industries=industries)


def fixture_params() -> Params:
    """Parameters for the derived test views (see FIXTURES.md).

    Dates in the fixtures run 1995-01 .. 2001-11, so every industry uses the
    period [1996010100, 2001010100); ALL starts 1998-06-01; the run date is
    2001-01-15, so published months end before 2000-12-01.
    """
    start, end = 1996010100, 2001010100
    return Params(
        asof=_dt.date(2001, 1, 15),
        all_since=_dt.date(1998, 6, 1),
        fare_cap=100000,
        distance_cap=45,
        time_cap_secs=7200,
        old_hv_start=1998060100,
        old_hv_end=end,
    ).with_period(start, end)
