"""Money aggregations: zone financials (A7) and monthly fare tables.

Measures are declared as ``(name, SQL text)`` lists per industry kind and applied in
one aggregation; Spark computes every sum and count in a single pass with
map-side partial aggregation. The exact driver count (A12, ``count(distinct)``)
is planned as a two-level aggregation -- first by (month, driver), then by month
-- so one hot driver or month never lands whole in one task.

NULL rules differ by column and are kept exactly (SURVEY 2.12): ``avg(x)``
ignores NULL, ``avg(coalesce(x,0))`` counts it as 0, ``avg(nullif(x,0))``
averages payers only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from farezone import config as C
from farezone.config import Industry
from farezone.functions.money import exact_avg, money_avg, money_sum, null_if_zero, ratio, rider_total, to_minutes, total, zero_if_null
from farezone.functions.text import sql
from farezone.functions.timekeys import MONTH_KEY
from farezone.operators.filters import in_period, shared_only, valid_trip, within_caps

# Fare parts a high-volume rider pays, in the published order.
HV_FARE_PARTS = ("base_passenger_fare", "tolls", "bcf", "sales_tax",
                 "congestion_surcharge", "airport_fee", "tips")
#: Money columns of the hv fare tables, in the published order.
HV_MONEY = ("base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge",
            "tips", "driver_pay", "airport_fee")


def fare_expr(industry: Industry) -> str:
    if industry.company_col is not None or industry.shared_only:
        return rider_total(HV_FARE_PARTS)
    return industry.fare


def financial_trips(df: DataFrame, industry: Industry, start: int, end: int,
                    fare_cap, distance_cap, time_cap_secs) -> DataFrame:
    """F1-F4 as the zone-financials queries apply them (with the time cap)."""
    df = in_period(df, start, end)
    if industry.shared_only:
        df = shared_only(df)
    df = valid_trip(df, industry)
    return within_caps(df, industry, fare_cap, distance_cap, time_cap_secs)


def zone_financials(df: DataFrame, industry: Industry) -> DataFrame:
    """Per month and pickup: average and total fare, minutes, distance.

    Metered industries use ``total_amount``; hv and shared use the rider total
    (P8). The average fare is the average of the per-trip sum. NULL pickups
    form their own group here (dropped later by the zone expansion).
    """
    return sql(df, f"""
        SELECT year_month, pulocationid, {", ".join(financial_measures("fare", "seconds", "distance"))}
        FROM (SELECT {MONTH_KEY} AS year_month, pulocationid, {fare_expr(industry)} AS fare,
                     {industry.seconds} AS seconds, {industry.distance} AS distance FROM {{df}})
        GROUP BY year_month, pulocationid""")


def financial_measures(fare: str, seconds: str, distance: str) -> list[str]:
    """The measures of A7, named."""
    return [f"{money_avg(fare)} AS avg_total_fare", f"CAST({total(fare)} AS double) AS sum_total_fare",
            f"{to_minutes(exact_avg(seconds))} AS avg_trip_time", f"{exact_avg(distance)} AS avg_trip_distance"]


def fare_trips(df: DataFrame, industry: Industry, start: int, end: int,
               fare_cap, distance_cap) -> DataFrame:
    """F1-F4 as the monthly fare queries apply them (no time cap)."""
    df = in_period(df, start, end)
    if industry.shared_only:
        df = shared_only(df)
    df = valid_trip(df, industry)
    return within_caps(df, industry, fare_cap, distance_cap)


class TripTerms:
    """What fare measures are made of, as aggregates over trips."""

    def __init__(self, driver: str):
        self._driver = driver

    def money(self, c: str) -> str:
        return money_sum(c)

    def number(self, c: str) -> str:
        return f"sum({c})"

    def count(self, c: str) -> str:
        return f"count({c})"

    def payers(self, c: str) -> str:
        return f"count({null_if_zero(c)})"

    def rows(self) -> str:
        return "count(1)"

    def drivers(self) -> str:
        return f"count(DISTINCT {self._driver})"


def _double(x: str) -> str:
    return f"CAST({x} AS double)"


def _total(t, c: str) -> str:
    """Sum with NULL as 0."""
    return zero_if_null(t.money(c))


def _avg(t, c: str) -> str:
    return ratio(t.money(c), t.count(c))


def _payer_avg(t, c: str) -> str:
    """Average over non-zero values (P7): zeros don't change the sum, only the count."""
    return ratio(t.money(c), t.payers(c))


def _filled_avg(t, c: str) -> str:
    """Average with NULL as 0 (P6), over all rows."""
    return ratio(_total(t, c), t.rows())


def _metered_measures(t, airport_fee: bool, extra_payers_only: bool) -> list[tuple[str, str]]:
    # one exact sum for each column, whatever the measures made of it
    drivers = t.drivers()
    m = [
        ("avg_total_fare", _avg(t, "total_amount")),
        ("sum_total_fare", _double(_total(t, "total_amount"))),
        ("avg_fare_amount", _avg(t, "fare_amount")),
        ("sum_fare_amount", _double(_total(t, "fare_amount"))),
        ("avg_extra", (_payer_avg if extra_payers_only else _filled_avg)(t, "extra")),
        ("sum_extra", _double(_total(t, "extra"))),
        ("mta_tax", f"{C.MTA_TAX}D"),
        ("total_mta_tax", _double(_total(t, "mta_tax"))),
        ("avg_tip_amount", _payer_avg(t, "tip_amount")),
        ("sum_tip_amount", _double(_total(t, "tip_amount"))),
        ("avg_tolls_amount", _payer_avg(t, "tolls_amount")),
        ("sum_tolls_amount", _double(_total(t, "tolls_amount"))),
        ("improvement_surcharge", f"{C.IMPROVEMENT_SURCHARGE}D"),
        ("sum_improvement_surcharge", _double(_total(t, "improvement_surcharge"))),
        ("avg_congestion_surcharge", _payer_avg(t, "congestion_surcharge")),
        ("sum_congestion_surcharge", _double(_total(t, "congestion_surcharge"))),
    ]
    if airport_fee:
        m += [("avg_airport_fee", _payer_avg(t, "airport_fee")),
              ("sum_airport_fee", _double(_total(t, "airport_fee")))]
    pay = f"({_total(t, 'fare_amount')} + {_total(t, 'extra')})"
    m += [
        ("avg_distance", ratio(t.number("trip_distance"), t.count("trip_distance"))),
        ("count_drivers", drivers),
        ("driver_pay", f"{_avg(t, 'fare_amount')} + {_filled_avg(t, 'extra')}"),
        ("total_driver_pay", _double(pay)),
        ("pay_per_driver", ratio(pay, drivers)),
        ("tips_per_driver", ratio(_total(t, "tip_amount"), drivers)),
        ("extra_per_driver", ratio(_total(t, "extra"), drivers)),
        ("fare_per_driver", ratio(_total(t, "fare_amount"), drivers)),
    ]
    return m


def _hv_measures(t) -> list[tuple[str, str]]:
    drivers = t.drivers()
    m = []
    for p in HV_MONEY:
        m += [(f"avg_{p}", _avg(t, p)), (f"sum_{p}", _double(_total(t, p)))]
    m += [
        ("avg_distance", ratio(t.number("trip_miles"), t.count("trip_miles"))),
        ("count_drivers", drivers),
        ("driver_pay", _avg(t, "driver_pay")),
        ("total_driver_pay", _double(t.money("driver_pay"))),
        ("pay_per_driver", ratio(t.money("driver_pay"), drivers)),
        ("tips_per_driver", ratio(_total(t, "tips"), drivers)),
        ("sum_total_fare", _double(" + ".join(_total(t, p) for p in HV_FARE_PARTS))),
        # a sum of averages: NULL when any part is NULL for the whole month
        ("avg_total_fare", " + ".join(_avg(t, p) for p in HV_FARE_PARTS)),
    ]
    return m


def fare_measures(industry: Industry, terms) -> list[tuple[str, str]]:
    """The measure list of A8 (yellow), A9 (green) or A10/A11 (hv, shared), made of ``terms``."""
    if industry.name == "yellow":
        return _metered_measures(terms, airport_fee=True, extra_payers_only=False)
    if industry.name == "green":
        return _metered_measures(terms, airport_fee=False, extra_payers_only=True)
    return _hv_measures(terms)


def driver_column(industry: Industry) -> str:
    return "hack_number" if industry.name in ("yellow", "green") else "tlc_driver_license_num"


def monthly_fares(df: DataFrame, industry: Industry) -> DataFrame:
    """The monthly fare breakdown, one row per month key (YYYYMM)."""
    measures = ", ".join(f"{x} AS {n}" for n, x in fare_measures(industry, TripTerms(driver_column(industry))))
    return sql(df, f"SELECT {MONTH_KEY} AS year_month, {measures} FROM {{df}} GROUP BY {MONTH_KEY}")
