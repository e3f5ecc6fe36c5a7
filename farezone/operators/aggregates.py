"""Trip counts: origin/destination tables (A1-A4) and their marginals.

The OD table is the eager aggregate of the trip fact: every later step (zone
volume, pickups, drop-offs) reads it, never the trips. Its group-by runs with
partial aggregation in each scan task, so a hot pickup zone or base holding a
third of all trips collapses to one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farezone import config as C
from farezone.config import Industry, Params
from farezone.functions.labels import license_to_company
from farezone.functions.text import literal, sql
from farezone.functions.timekeys import MONTH_KEY
from farezone.operators.checks import Checks
from farezone.operators.filters import company_in, company_not_in, in_period, shared_only, valid_trip

OD_KEYS = ("year_month", "pulocationid", "dolocationid")


def od_counts(trips: DataFrame, *extra_keys: str) -> DataFrame:
    """A1: trips per month key (YYYYMM), pickup, drop-off (and extra keys).

    NULL ids form their own group, as in SQL. ``count`` counts non-NULL hour keys.
    """
    keys = ", ".join(["pulocationid", "dolocationid", *extra_keys])
    return sql(trips, f"""
        SELECT {MONTH_KEY} AS year_month, {keys}, count(datetimeid) AS count FROM {{df}} GROUP BY {MONTH_KEY}, {keys}""")


def filtered_trips(trips: DataFrame, industry: Industry, start: int, end: int, checks: Checks | None = None) -> DataFrame:
    """F1 + F2 (+ F4 for shared rides) as the trip-count queries apply them; ``checks`` counts between F1 and F2."""
    df = in_period(trips, start, end)
    if checks is not None:
        df = checks.trips(industry.name, df, industry)
    df = valid_trip(df, industry)
    return shared_only(df) if industry.shared_only else df


def fhv_rows(fhv: DataFrame, bases: DataFrame, start: int, end: int) -> DataFrame:
    """fhv trips in the period with their base's company (J1), as rows ``(year_month,
    pulocationid, dolocationid, company, count)``.

    The base list is reduced to ``(lic_no, company, n)`` first, so a duplicate licence
    multiplies its trips (``count`` is n) without multiplying rows. The join is map-side for
    any list that Spark broadcasts; aggregating per base before it would shuffle nearly every
    trip (a base, month and zone pair rarely recur), so nothing is aggregated before the join.
    """
    b = sql(bases, "SELECT lic_no, company, count(1) AS n FROM {df} GROUP BY lic_no, company")
    t = in_period(fhv, start, end)
    # a join of DataFrames: a stream's batch belongs to another session than the base list
    return sql(t.join(b, t["dispatching_base_num"] == b["lic_no"]), f"""
        SELECT {MONTH_KEY} AS year_month, pulocationid, dolocationid, company,
               CASE WHEN datetimeid IS NOT NULL THEN n ELSE 0L END AS count FROM {{df}}""")


def od_counts_traditional(fhv: DataFrame, bases: DataFrame, start: int, end: int) -> DataFrame:
    """A2: fhv OD counts for companies outside the high-volume four (NULL dropped)."""
    j = company_not_in(fhv_rows(fhv, bases, start, end), C.HV_COMPANIES)
    return _summed(j, *OD_KEYS)


def od_counts_old_hv(fhv: DataFrame, bases: DataFrame, start: int, end: int) -> DataFrame:
    """A4: fhv OD counts by company for the high-volume four (before the hv table)."""
    j = company_in(fhv_rows(fhv, bases, start, end), C.HV_COMPANIES)
    return _summed(j, *OD_KEYS, "company")


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    listed = ", ".join(keys)
    return sql(rows, f"SELECT {listed}, sum(count) AS count FROM {{df}} GROUP BY {listed}")


def od_counts_by_license(hv: DataFrame, start: int, end: int, industry: Industry = C.HVFHV) -> DataFrame:
    """A3: hv OD counts by licence code."""
    return od_counts(filtered_trips(hv, industry, start, end), "hvfhs_license_num")


def _trip_rows(name: str, company: str, shared: str = "false") -> str:
    """The filtered trips of frame ``name`` as rows ``(year_month, pulocationid, dolocationid,
    company, count, shared)``: ``count`` is 1 for a trip with an hour key (``count(datetimeid)``), and
    so is ``shared`` if the trip also counts as a shared ride."""
    return f"""SELECT {MONTH_KEY} AS year_month, pulocationid, dolocationid, {company} AS company,
                      CAST(datetimeid IS NOT NULL AS bigint) AS count,
                      CAST(datetimeid IS NOT NULL AND {shared} AS bigint) AS shared FROM {{{name}}}"""


def industry_rows(trips: dict, bases: DataFrame, params: Params, checks: Checks | None = None) -> DataFrame:
    """The trips of all industries as rows, one for each trip (see :func:`_trip_rows`), unioned.

    The hv table is read once: a ride with a route id is flagged ``shared`` (when the hv and
    shared bounds agree), and becomes a second row only after it has been summed."""
    ind = params.industry
    y, g, hv, sh = ind("yellow"), ind("green"), ind("hvfhv"), ind("shared")
    end = params.trips_end
    trad, fhv_trips = ind(C.TRADITIONAL_TAG), trips["fhv"]
    if checks is not None:
        fhv_trips = checks.trips(trad.name, in_period(fhv_trips, trad.trips_start, end), trad)
    frames = {"yellow": filtered_trips(trips["yellow"], y, y.trips_start, end, checks),
              "green": filtered_trips(trips["green"], g, g.trips_start, end, checks),
              "fhv": company_not_in(fhv_rows(fhv_trips, bases, trad.trips_start, end), C.HV_COMPANIES),
              "hv": filtered_trips(trips["hvfhv"], hv, hv.trips_start, end, checks)}
    fhv = f"SELECT {', '.join(OD_KEYS)}, {literal(C.TRADITIONAL_TAG)} AS company, count, 0L AS shared FROM {{fhv}}"
    parts = [_trip_rows("yellow", "'yellow'"), _trip_rows("green", "'green'"), fhv]
    hv_company = license_to_company("hvfhs_license_num")
    if hv.trips_start == sh.trips_start and hv.has_measures == sh.has_measures:
        parts.append(_trip_rows("hv", hv_company, "route_id IS NOT NULL"))
    else:
        frames["sh"] = filtered_trips(trips["hvfhv"], sh, sh.trips_start, end)
        parts += [_trip_rows("hv", hv_company), _trip_rows("sh", "'shared'")]
    return trips["yellow"].sparkSession.sql(" UNION ALL ".join(parts), **frames)


def _counted(rows: DataFrame, *keys: str) -> DataFrame:
    """Counts by the keys and company; shared rides as rows of their own, made from the sums.

    A licence with shared rides gives one ``shared`` row each, so those are summed once more,
    over aggregates only."""
    listed = ", ".join(keys)
    return sql(rows, f"""
        SELECT {listed}, company, sum(count) AS count
        FROM (SELECT {listed}, inline(array(struct(company AS company, counted AS count), struct('shared' AS company, shared AS count)))
              FROM (SELECT {listed}, company, sum(count) AS counted, sum(shared) AS shared FROM {{df}} GROUP BY {listed}, company))
        WHERE count > 0 GROUP BY {listed}, company""")


def industry_od(trips: dict, bases: DataFrame, params: Params, checks: Checks | None = None) -> DataFrame:
    """All five OD tables, each with its company, as one table ``(year_month,
    pulocationid, dolocationid, company, count)``, unique per key.

    Plan: one aggregation over the union of the filtered scans (partial aggregation in every
    scan task), then the shared rides' sums become rows and are summed over the licences.
    """
    od = _counted(industry_rows(trips, bases, params, checks), *OD_KEYS)
    return od if checks is None else checks.counts(od)


def industry_marginal(trips: dict, bases: DataFrame, params: Params, side: str) -> DataFrame:
    """A5 straight from the trips: counts per month, company and the id in column ``side``
    (pickup or drop-off), without the OD table in between; NULL ids dropped."""
    rows = sql(industry_rows(trips, bases, params),
               f"SELECT year_month, {side} AS id, company, count, shared FROM {{df}} WHERE {side} IS NOT NULL")
    return _counted(rows, "year_month", "id").select("year_month", "id", "company", "count")


def pickups(od: DataFrame, keys=("company",)) -> DataFrame:
    """A5: pickups per month, pickup id (and company); NULL pickups dropped."""
    return (od.filter(F.col("pulocationid").isNotNull())
              .groupBy("year_month", F.col("pulocationid").alias("id"), *keys)
              .agg(F.sum("count").alias("count")))


def dropoffs(od: DataFrame, keys=("company",)) -> DataFrame:
    """A5: drop-offs per month, drop-off id (and company); NULL drop-offs dropped."""
    return (od.filter(F.col("dolocationid").isNotNull())
              .groupBy("year_month", F.col("dolocationid").alias("id"), *keys)
              .agg(F.sum("count").alias("count")))


def distinct_companies(df: DataFrame, col: str = "company") -> DataFrame:
    """The distinct company labels (a sanity check of the labelling)."""
    return df.select(col).distinct()
