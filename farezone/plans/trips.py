"""Pipeline A: the trips mart.

Plan shape (nothing collected; four shuffles in all, each over a partial aggregate):

  trip scans (each read once; period and publication cutoff pushed to Parquet)
     fhv: joined with the base list (map-side, broadcast by size)
     --union, partial agg--> OD per licence                      [shuffle 0]
     --shared rides as rows, partial agg--> OD                    [shuffle 1]
     --> interim Parquet in the shared checkpoint folder (S7)
  OD --zone bit mask of each end (broadcast), pickup and drop-off side-->
     sums per id: pickups, drop-offs, inbound of each zone      [shuffle 2]
     --set bits to zones--(Trips, PickUps, DropOffs)--(own label, ALL)-->
  final sum                                                     [shuffle 3]
     --broadcast zone names--> mart
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farezone import config as C
from farezone.config import Params
from farezone.functions.labels import strip_spaces, to_sector, upper_label
from farezone.functions.text import literal, sql
from farezone.functions.timekeys import month_date, run_bounds
from farezone.operators.aggregates import industry_od
from farezone.operators.checks import Checks
from farezone.operators.filters import before_month, drop_null_key, exclude_company
from farezone.operators.joins import in_zone, with_zone_name
from farezone.operators.rollups import counts_for_all, final_sum
from farezone.operators.zones import expand_zones, zone_members, zone_metrics
from farezone.plans.inputs import TripInputs
from farezone.sources.readers import zone_names
from farezone.sources.sinks import write_interim


def label_rows(df: DataFrame) -> DataFrame:
    """Month key -> date; company label (P13; spaces are stripped at the mart's end)."""
    return df.withColumns({"year_month": month_date("year_month"), "company": F.expr(upper_label("company"))})


def by_zone(marginal: DataFrame, matrix: DataFrame, names: DataFrame, metric: str) -> DataFrame:
    """Labelled pickups (or drop-offs) -> zone name -> every service zone."""
    d = with_zone_name(label_rows(marginal), names)
    return (expand_zones(d, zone_members(matrix), zone_col="Z")
            .withColumnRenamed("zone", "Zone")
            .withColumn("metric", F.lit(metric)))


def citywide_trips(pu: DataFrame, matrix: DataFrame) -> DataFrame:
    """City-wide Trips = pickups at ids in Citywide (no trip starts outside the city)."""
    city = zone_members(matrix).filter(F.col("zone") == C.CITYWIDE)
    return (in_zone(pu, city)
            .withColumn("Z", F.lit(C.CITYWIDE))
            .withColumn("metric", F.lit(C.METRIC_TRIPS)))


def combined_metrics(od: DataFrame, matrix: DataFrame) -> DataFrame:
    """Trips, PickUps and DropOffs rows per month, id, company label, service zone.

    One :func:`zone_metrics` aggregation over every zone gives all three: PickUps
    and DropOffs directly; Trips = pickups + inbound (zone volume, J2) for every
    zone but Citywide, and the pickups alone for Citywide (C3). Zone names are
    attached after the mart's final sum.
    """
    trips = f"CASE WHEN zone = {literal(C.CITYWIDE)} THEN pickups ELSE pickups + coalesce(inbound, 0L) END"
    metrics = ", ".join(f"struct({literal(m)} AS metric, {c} AS count)" for m, c in
                        ((C.METRIC_TRIPS, trips), (C.METRIC_PICKUPS, "pickups"), (C.METRIC_DROPOFFS, "dropoffs")))
    rows = sql(zone_metrics(od, matrix), f"""
        SELECT * FROM (SELECT year_month, id, company, zone AS Z, inline(array({metrics})) FROM {{df}})
        WHERE count IS NOT NULL""")
    return label_rows(rows)


def finish_mart(combined: DataFrame, names: DataFrame, params: Params) -> DataFrame:
    """C4 tail: ALL rollup (A15), cutoff (F10), HVFHV (P14), final sum (A16), drop FHV.

    Each row is emitted under its own (sector) label and, when it qualifies for
    the ALL rollup (not SHARED, month since ``all_since``), once more as ``ALL``
    -- so the rollup and the final sum are one aggregation, one shuffle. Names are
    joined afterwards, as ``(id, Zone, n)``: ids without a name, or with a NULL one,
    drop out, and an id that the lookup holds n times under one name counts n times,
    in one row (A16 sums by ``Zone``, which the lookup repeats).
    """
    rows = sql(drop_null_key(before_month(combined, params.asof), "id", "Z"), f"""
        SELECT * FROM (SELECT year_month, id, Z, metric, count,
                              explode(array({to_sector(strip_spaces("company"))},
                                            CASE WHEN {counts_for_all(params.all_since)} THEN {literal(C.ALL_LABEL)} END)) AS company
                       FROM {{df}})
        WHERE company IS NOT NULL""")
    summed = exclude_company(final_sum(rows, keys=("year_month", "id", "company", "Z", "metric")), C.MART_EXCLUDED)
    return sql(summed, """
        SELECT year_month, id, company, Z, Zone, metric, count * n AS count
        FROM {df} JOIN (SELECT id, zone AS Zone, count(1) AS n FROM {names} WHERE zone IS NOT NULL GROUP BY id, zone) USING (id)""",
               names=names)


def published_period(params: Params) -> Params:
    """Move the publication cutoff (F10) into the scan: every mart row belongs to
    one month, so trips of months that will not be published are never read.
    The bound is on the raw hour key, so Parquet skips them (``PushedFilters``)."""
    _, end = run_bounds(params.asof)
    return replace(params, trips_end=min(params.trips_end, end))


def trips_mart(inputs: TripInputs, params: Params, interim: bool = True, checks: Checks | None = None) -> DataFrame:
    """C4: the published trips mart ``(year_month, id, company, Z, Zone, metric, count)``.

    With ``interim`` the OD table is written to the shared checkpoint folder (S7)
    and the mart reads it from there: the lineage is cut after the trip scans, so
    a lost executor (or a rerun of the downstream stages) re-reads a small table
    instead of rescanning the trips. ``checks`` is filled by the job that writes it.
    """
    od = industry_od(inputs.trips(), inputs.bases, published_period(params), checks)
    if interim:
        od = write_interim(od, "od")
    names = zone_names(inputs.zone_lookup)
    return finish_mart(combined_metrics(od, inputs.zone_matrix), names, params)
