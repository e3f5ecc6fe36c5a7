"""Registered queries: one per operator or plan, over the derived test views.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables in
``sf_dir``. It is lazy but where writing a table is the feature (the OD interim of the
mart, published tables that are read back). Names match the DuckDB oracle in ``farezone_oracle/duckdb_sql.py``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farezone import config as C
from farezone.config import fixture_params, since
from farezone.operators import aggregates as A
from farezone.operators.fares import financial_trips, zone_financials
from farezone.operators.filters import in_period
from farezone.operators.joins import trips_with_base
from farezone.operators.rollups import all_companies
from farezone.operators.zones import inbound, zone_members, zone_volume
from farezone.plans import trips as T
from farezone.plans.fare_state import add_trips, fares_kept
from farezone.plans.fares import FARE_SOURCES, fares_long, fares_wide
from farezone.plans.fhv import traditional_fhv_totals
from farezone.plans.financials import zone_financials_mart
from farezone.plans.inputs import TripInputs, joined_trip_views
from farezone.plans.slice import mart_slice
from farezone.sources.readers import (read_bases, read_mart, read_trips, read_zone_matrix, read_zone_names,
                                      zone_names)
from farezone.sources.sinks import extend_mart, interim_scope, publish, shared_dir, splice_history, write_csv

P = fixture_params()


def _inputs(spark: SparkSession, sf_dir: str) -> TripInputs:
    # lazy views over the given tables: nothing runs before the returned DataFrame does
    return TripInputs.from_fixtures(spark, sf_dir, materialize=False)


def _trip_od(spark, sf_dir, name):
    inp = _inputs(spark, sf_dir)
    ind = P.industry(name)
    return inp, ind


# -- A1-A4: origin/destination counts ---------------------------------------

def od_counts_yellow(spark, sf_dir):
    inp, ind = _trip_od(spark, sf_dir, "yellow")
    return A.od_counts(A.filtered_trips(inp.yellow, ind, ind.trips_start, P.trips_end))


def od_counts_green(spark, sf_dir):
    inp, ind = _trip_od(spark, sf_dir, "green")
    return A.od_counts(A.filtered_trips(inp.green, ind, ind.trips_start, P.trips_end))


def od_counts_traditional(spark, sf_dir):
    inp, ind = _trip_od(spark, sf_dir, "no_hv")
    return A.od_counts_traditional(inp.fhv, inp.bases, ind.trips_start, P.trips_end)


def od_counts_old_hv(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return A.od_counts_old_hv(inp.fhv, inp.bases, P.old_hv_start, P.old_hv_end)


def od_counts_by_license(spark, sf_dir):
    inp, ind = _trip_od(spark, sf_dir, "hvfhv")
    return A.od_counts_by_license(inp.hvfhv, ind.trips_start, P.trips_end, ind)


def od_counts_shared(spark, sf_dir):
    """A1 + F4: shared-ride OD counts (in the trips mart the same rides come from
    the single hv scan of ``industry_od``, see ``od_all_industries``)."""
    inp, ind = _trip_od(spark, sf_dir, "shared")
    return A.od_counts(A.filtered_trips(inp.hvfhv, ind, ind.trips_start, P.trips_end))


def fhv_with_base(spark, sf_dir):
    """Fhv trips in the period with their base's company."""
    inp, ind = _trip_od(spark, sf_dir, "no_hv")
    return trips_with_base(in_period(inp.fhv, ind.trips_start, P.trips_end), inp.bases)


def _od(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return inp, A.industry_od(inp.trips(), inp.bases, P)


# -- A5, A6, J2, R3: marginals and zones ------------------------------------

def od_all_industries(spark, sf_dir):
    """C1 input: the OD table of all five industries with their company, one aggregation."""
    _, od = _od(spark, sf_dir)
    return od


def _marginal(spark, sf_dir, side):
    inp = _inputs(spark, sf_dir)
    return inp, A.industry_marginal(inp.trips(), inp.bases, P, side)


def pickups_all(spark, sf_dir):
    return _marginal(spark, sf_dir, "pulocationid")[1]


def dropoffs_all(spark, sf_dir):
    return _marginal(spark, sf_dir, "dolocationid")[1]


def zone_members_q(spark, sf_dir):
    return zone_members(_inputs(spark, sf_dir).zone_matrix)


def inbound_all(spark, sf_dir):
    inp, od = _od(spark, sf_dir)
    return inbound(od, inp.zone_matrix, exclude=(C.CITYWIDE,))


def zone_volume_all(spark, sf_dir):
    inp, od = _od(spark, sf_dir)
    return zone_volume(od, inp.zone_matrix, exclude=(C.CITYWIDE,))


# -- C2, C3, A15, C4, C8: trips mart ------------------------------------------

def pickups_by_zone(spark, sf_dir):
    inp, pu = _marginal(spark, sf_dir, "pulocationid")
    return T.by_zone(pu, inp.zone_matrix, zone_names(inp.zone_lookup), C.METRIC_PICKUPS)


def dropoffs_by_zone(spark, sf_dir):
    inp, do = _marginal(spark, sf_dir, "dolocationid")
    return T.by_zone(do, inp.zone_matrix, zone_names(inp.zone_lookup), C.METRIC_DROPOFFS)


def citywide_trips(spark, sf_dir):
    inp, pu = _marginal(spark, sf_dir, "pulocationid")
    return T.label_rows(T.citywide_trips(pu, inp.zone_matrix))


def all_companies_q(spark, sf_dir):
    """A15 on the combined metrics, with zone names attached (ALL needs a name)."""
    inp, od = _od(spark, sf_dir)
    comb = T.combined_metrics(od, inp.zone_matrix)
    names = zone_names(inp.zone_lookup).withColumnRenamed("zone", "Zone")
    comb = comb.join(names, "id", "left")
    return all_companies(comb, P.all_since)


def trips_mart(spark, sf_dir):
    return T.trips_mart(_inputs(spark, sf_dir), P)


MART_LAYOUT = ("metric", "year_month")


def _fresh(spark, name):
    """A new folder under the shared checkpoint folder, for a table that a query publishes."""
    return f"{shared_dir(spark)}/published/{name}-{uuid.uuid4().hex}"


def _publish_mart(spark, sf_dir, fmt="parquet", inputs=None):
    """The trips mart, published as production does; the path."""
    path = _fresh(spark, "trips_mart")
    mart = T.trips_mart(inputs or _inputs(spark, sf_dir), P).withColumn("count", F.col("count").cast("double"))
    publish(mart, path, MART_LAYOUT, fmt, ("id", "company", "Z"))
    return path


def _published_mart(spark, sf_dir, fmt="parquet"):
    """The published trips mart, read back (counts as integers again)."""
    mart = read_mart(spark, _publish_mart(spark, sf_dir, fmt), fmt)
    return mart.withColumn("count", F.col("count").cast("long"))


def mart_slice_q(spark, sf_dir):
    """C8 on the published mart: metric and months prune its partition folders."""
    return mart_slice(_published_mart(spark, sf_dir), C.METRIC_TRIPS, zones=["Core", "Midtown"],
                      companies=["YELLOW", "HVFHV", "ALL"], start=dt.date(1999, 1, 1), end=dt.date(2000, 7, 1))


def distinct_companies(spark, sf_dir):
    return A.distinct_companies(_published_mart(spark, sf_dir))


# -- S1-S4, S6, S8-S10: written, then read back --------------------------------------

def read_trips_q(spark, sf_dir):
    """The yellow trips as files, read with the files' own types."""
    path = _fresh(spark, "yellow")
    _inputs(spark, sf_dir).yellow.write.parquet(path)
    return read_trips(spark, path, "yellow")


def read_bases_q(spark, sf_dir):
    """S2"""
    path = _fresh(spark, "bases")
    _inputs(spark, sf_dir).bases.write.parquet(path)
    return read_bases(spark, path)


def read_zone_matrix_q(spark, sf_dir):
    """S3: the wide matrix as CSV."""
    path = _fresh(spark, "zone_matrix")
    return read_zone_matrix(spark, write_csv(_inputs(spark, sf_dir).zone_matrix, path))


def read_zone_names_q(spark, sf_dir):
    """S4"""
    path = _fresh(spark, "zone_lookup")
    _inputs(spark, sf_dir).zone_lookup.write.parquet(path)
    return zone_names(read_zone_names(spark, path))


def read_mart_q(spark, sf_dir):
    """The published Parquet mart."""
    return _published_mart(spark, sf_dir)


def mart_csv(spark, sf_dir):
    """The mart published as CSV, read back."""
    return _published_mart(spark, sf_dir, "csv")


def extend_mart_q(spark, sf_dir):
    """The trips mart extended by the financials, twice: as if once. Three plans read the
    trips (ten scans of views), so the join behind these is written once."""
    with interim_scope(spark):
        inputs = _inputs(spark, sf_dir).with_trips(joined_trip_views(spark, sf_dir))
        path = _publish_mart(spark, sf_dir, inputs=inputs)
        for _ in range(2):
            extend_mart(zone_financials_mart(inputs, P), path, MART_LAYOUT)
    return read_mart(spark, path)


def splice_history_q(spark, sf_dir):
    """Published months before the cutoff, newly computed ones from it on."""
    cutoff = dt.date(2000, 3, 1)
    new = T.trips_mart(_inputs(spark, sf_dir), since(P, cutoff))
    return splice_history(_published_mart(spark, sf_dir), new, cutoff)


# -- A7, C5: zone financials ---------------------------------------------------

def _financials(name, source):
    def q(spark, sf_dir):
        inp = _inputs(spark, sf_dir)
        ind = P.industry(name)
        t = financial_trips(inp.trips()[source], ind, ind.financials_start, ind.financials_end,
                            P.fare_cap, P.distance_cap, P.time_cap_secs)
        return zone_financials(t, ind)
    return q


def zone_financials_mart_q(spark, sf_dir):
    return zone_financials_mart(_inputs(spark, sf_dir), P)


# -- A8-A11, R2, C6: fare tables ---------------------------------------------

def _fares(name, long=False):
    def q(spark, sf_dir):
        w = fares_wide(_inputs(spark, sf_dir), P, name)
        return fares_long(w) if long else w
    return q


def _fares_late(name):
    def q(spark, sf_dir):
        """A8-A12 from kept state: the trips of every other day arrive late and are merged."""
        trips, out = _inputs(spark, sf_dir).trips()[FARE_SOURCES[name]], _fresh(spark, f"{name}_state")
        late = F.pmod(F.floor(F.col("datetimeid") / 100), F.lit(2)) == 1
        add_trips(spark, out, trips.where(~late | late.isNull()), P, name, files=["in time"])
        add_trips(spark, out, trips.where(late), P, name, files=["late"])
        return fares_kept(spark, out, P, name)
    return q


# -- A13, A14, C7 ---------------------------------------------------------------

def fhv_totals(spark, sf_dir):
    return traditional_fhv_totals(_inputs(spark, sf_dir).daily, P)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "od_counts_yellow": od_counts_yellow,
    "od_counts_green": od_counts_green,
    "od_counts_traditional": od_counts_traditional,
    "od_counts_old_hv": od_counts_old_hv,
    "od_counts_by_license": od_counts_by_license,
    "od_counts_shared": od_counts_shared,
    "fhv_with_base": fhv_with_base,
    "od_all_industries": od_all_industries,
    "pickups_all": pickups_all,
    "dropoffs_all": dropoffs_all,
    "zone_members": zone_members_q,
    "inbound_all": inbound_all,
    "zone_volume_all": zone_volume_all,
    "pickups_by_zone": pickups_by_zone,
    "dropoffs_by_zone": dropoffs_by_zone,
    "citywide_trips": citywide_trips,
    "all_companies": all_companies_q,
    "trips_mart": trips_mart,
    "mart_slice": mart_slice_q,
    "distinct_companies": distinct_companies,
    "zone_financials_yellow": _financials("yellow", "yellow"),
    "zone_financials_green": _financials("green", "green"),
    "zone_financials_hvfhv": _financials("hvfhv", "hvfhv"),
    "zone_financials_shared": _financials("shared", "hvfhv"),
    "zone_financials_mart": zone_financials_mart_q,
    "fares_yellow": _fares("yellow"),
    "fares_green": _fares("green"),
    "fares_hvfhv": _fares("hvfhv"),
    "fares_shared": _fares("shared"),
    "fares_yellow_long": _fares("yellow", long=True),
    "fares_green_long": _fares("green", long=True),
    "fares_hvfhv_long": _fares("hvfhv", long=True),
    "fares_shared_long": _fares("shared", long=True),
    "fares_yellow_late": _fares_late("yellow"),
    "fares_green_late": _fares_late("green"),
    "fares_hvfhv_late": _fares_late("hvfhv"),
    "fhv_totals": fhv_totals,
    "read_trips": read_trips_q,
    "read_bases": read_bases_q,
    "read_zone_matrix": read_zone_matrix_q,
    "read_zone_names": read_zone_names_q,
    "read_mart": read_mart_q,
    "mart_csv": mart_csv,
    "extend_mart": extend_mart_q,
    "splice_history": splice_history_q,
}
