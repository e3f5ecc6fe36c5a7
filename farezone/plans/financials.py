"""Pipeline B: the zone financials mart (C5) -- A7 x 4 industries -> zones -> long."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farezone import config as C
from farezone.config import Params
from farezone.functions.labels import label_company
from farezone.functions.money import cents_sum, checked_sum, money_of, ratio, to_minutes, zero_if_null
from farezone.functions.timekeys import MONTH_KEY, month_date, run_bounds
from farezone.operators.fares import fare_expr, financial_trips
from farezone.operators.filters import before_month
from farezone.operators.joins import with_zone_name
from farezone.operators.reshape import to_long
from farezone.operators.zones import expand_zones, zone_members
from farezone.plans.inputs import TripInputs
from farezone.sources.readers import zone_names

# industry name -> trip table it reads
FINANCIAL_SOURCES = (("yellow", "yellow"), ("green", "green"), ("hvfhv", "hvfhv"), ("shared", "hvfhv"))


def industry_financials(inputs: TripInputs, params: Params) -> DataFrame:
    """A7 for each industry, tagged with the industry as company, stacked.

    Plan: per-trip (fare, seconds, distance) rows of all industries are unioned and summed by one
    aggregation; the hv table is read once. A shared ride is summed beside the others, by a flag in the
    key, and only the sums are counted under both ``hvfhv`` and ``shared`` (when their bounds agree).
    """
    trips = inputs.trips()
    ind = params.industry
    # months from the cutoff on are not published (F10): do not read them
    _, cutoff = run_bounds(params.asof)

    def filtered(name, source):
        i = ind(name)
        return financial_trips(trips[source], i, i.financials_start, min(i.financials_end or cutoff, cutoff),
                               params.fare_cap, params.distance_cap, params.time_cap_secs)

    def rows(frame, i, company, shared="false"):
        return f"""SELECT {MONTH_KEY} AS year_month, pulocationid, {company} AS company, {shared} AS shared,
                          CAST({fare_expr(i)} AS decimal(18,2)) AS fare, {i.seconds} AS seconds, {i.distance} AS distance FROM {{{frame}}}"""

    frames = {"yellow": filtered("yellow", "yellow"), "green": filtered("green", "green"), "hv": filtered("hvfhv", "hvfhv")}
    parts = [rows("yellow", ind("yellow"), "'yellow'"), rows("green", ind("green"), "'green'")]
    hv, sh = ind("hvfhv"), ind("shared")
    if (hv.financials_start, hv.financials_end) == (sh.financials_start, sh.financials_end):
        parts.append(rows("hv", hv, "'hvfhv'", "route_id IS NOT NULL"))
    else:
        frames["sh"] = filtered("shared", "hvfhv")
        parts += [rows("hv", hv, "'hvfhv'"), rows("sh", sh, "'shared'")]
    keys = "year_month, pulocationid, company"
    # of each part its cents and counts, which add up; then both labels of what was shared
    return inputs.yellow.sparkSession.sql(f"""
        SELECT {keys}, {ratio(money_of(checked_sum("cents")), "sum(fares)")} AS avg_total_fare,
               CAST({zero_if_null(money_of(checked_sum("cents")))} AS double) AS sum_total_fare,
               {to_minutes(ratio("sum(seconds)", "sum(n_seconds)"))} AS avg_trip_time,
               {ratio("sum(distance)", "sum(n_distance)")} AS avg_trip_distance
        FROM (SELECT year_month, pulocationid, explode(CASE WHEN shared THEN array(company, 'shared') ELSE array(company) END) AS company,
                     cents, fares, seconds, n_seconds, distance, n_distance
              FROM (SELECT {keys}, shared, {cents_sum("fare")} AS cents, count(fare) AS fares, sum(seconds) AS seconds,
                           count(seconds) AS n_seconds, sum(distance) AS distance, count(distance) AS n_distance
                    FROM ({" UNION ALL ".join(parts)}) GROUP BY {keys}, shared))
        GROUP BY {keys}""", **frames)


def financials_wide(fin: DataFrame, matrix: DataFrame, names: DataFrame, params: Params) -> DataFrame:
    """Zone expansion (all zones) on the pickup, names (left), labels, cutoff."""
    d = expand_zones(fin.withColumnRenamed("pulocationid", "id"), zone_members(matrix), zone_col="Z")
    d = with_zone_name(d, names).withColumnRenamed("zone", "Zone")
    d = (d.withColumn("year_month", month_date("year_month"))
          .withColumn("company", F.expr(label_company("company"))))
    return before_month(d, params.asof)


def zone_financials_mart(inputs: TripInputs, params: Params) -> DataFrame:
    """``(year_month, id, company, Z, Zone, metric, count)`` with the four
    financial measures as metrics. Ids without a zone name keep a NULL ``Zone``."""
    wide = financials_wide(industry_financials(inputs, params), inputs.zone_matrix,
                           zone_names(inputs.zone_lookup), params)
    return to_long(wide, ["year_month", "id", "company", "Z", "Zone"], list(C.FINANCIAL_METRICS),
                   "metric", "count", rename=C.FINANCIAL_METRICS)
