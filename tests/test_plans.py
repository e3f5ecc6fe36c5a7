"""Plan shape: filters reach the Parquet scan, zone joins are broadcast, each trip
table is scanned once for the OD table, and the fare tables keep exact distinct counts."""

import re

import pytest

from farezone.config import fixture_params
from farezone.operators.aggregates import industry_od
from farezone.operators.checks import Checks
from farezone.plans import trips as TP
from farezone.plans.fares import fares_wide
from farezone.plans.financials import industry_financials, zone_financials_mart
from farezone.plans.inputs import TripInputs

from conftest import SF_SMALL

P = fixture_params()


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def inputs(spark):
    return TripInputs.from_fixtures(spark, SF_SMALL)


def test_od_scans_each_trip_table_once_with_pushed_filters(inputs):
    p = plan(industry_od(inputs.trips(), inputs.bases, P))
    scans = re.findall(r"FileScan parquet [^\n]*", p)
    trip_scans = [s for s in scans if "datetimeid" in s]
    assert len(trip_scans) == 4, trip_scans          # yellow, green, fhv, hvfhv (+shared) once each
    for s in trip_scans:
        assert "GreaterThanOrEqual(datetimeid" in s and "LessThan(datetimeid" in s


def test_financials_scan_hv_once(inputs):
    p = plan(industry_financials(inputs, P))
    trip_scans = [s for s in re.findall(r"FileScan parquet [^\n]*", p) if "datetimeid" in s]
    assert len(trip_scans) == 3


def test_mart_zone_joins_are_broadcast(spark, inputs):
    p = plan(TP.trips_mart(inputs, P, interim=True))
    assert "SortMergeJoin" not in p
    assert "BroadcastHashJoin" in p


def test_fares_prune_columns(inputs):
    p = plan(fares_wide(inputs, P, "yellow"))
    scan = [s for s in re.findall(r"FileScan parquet [^\n]*", p) if "datetimeid" in s][0]
    assert "improvement_surcharge" in scan and "dolocationid" not in scan


def _exchanges_over_aggregates(p: str) -> list[tuple[str, str]]:
    """(exchange line, its child line) for every hash exchange in a plan string."""
    lines = p.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            out.append((line.strip(), lines[i + 1].strip() if i + 1 < len(lines) else ""))
    return out


@pytest.mark.parametrize("build", [
    lambda inp: industry_od(inp.trips(), inp.bases, P),
    lambda inp: industry_financials(inp, P),
    lambda inp: fares_wide(inp, P, "yellow"),
    lambda inp: fares_wide(inp, P, "hvfhv"),
    lambda inp: TP.trips_mart(inp, P),
    lambda inp: zone_financials_mart(inp, P),
], ids=["od", "financials", "fares_yellow", "fares_hvfhv", "trips_mart", "financials_mart"])
def test_no_raw_trip_rows_are_shuffled(inputs, build):
    """Every shuffle sits on a partial (or merge) aggregation: a hot key -- one
    zone, base, driver or month holding a third of all trips -- reaches the
    exchange as one row per task, never as its raw trips."""
    pairs = _exchanges_over_aggregates(plan(build(inputs)))
    assert pairs
    for ex, child in pairs:
        assert "HashAggregate" in child and ("partial_" in child or "merge_" in child), (ex, child)


def test_fhv_totals_one_shuffle_over_partial_aggregate(spark, inputs):
    from farezone.plans.fhv import traditional_fhv_totals

    pairs = _exchanges_over_aggregates(plan(traditional_fhv_totals(inputs.daily, P)))
    assert len(pairs) == 1 and "partial_sum" in pairs[0][1]


def test_base_join_beyond_the_bound_shuffles_and_agrees(spark, inputs):
    """Past Spark's byte threshold (0 here) the base list is not broadcast: the join
    shuffles, and the counts are the same as with the broadcast."""
    from farezone.operators.aggregates import od_counts_traditional

    ind = P.industry("no_hv")
    small = od_counts_traditional(inputs.fhv, inputs.bases, ind.trips_start, P.trips_end)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    prev_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = od_counts_traditional(inputs.fhv, inputs.bases, ind.trips_start, P.trips_end)
        p = plan(big)
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
        from collections import Counter
        assert Counter(tuple(r) for r in big.collect()) == Counter(tuple(r) for r in small.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        if prev_aqe is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", prev_aqe)


def test_checks_come_with_the_od_job_and_leave_the_filters_pushed(spark, inputs):
    """A17 and the counts of a run as observed metrics: no further job, filters still at the files."""
    checks = Checks()
    trips, start, end = inputs.trips(), 1996010100, P.trips_end
    od = industry_od(trips, inputs.bases, P, checks)
    scans = [s for s in re.findall(r"FileScan parquet [^\n]*", plan(od)) if "datetimeid" in s]
    assert len(scans) == 4 and all("GreaterThanOrEqual(datetimeid" in s for s in scans)
    counted = {tuple(r) for r in od.collect()}
    seen = checks.seen()
    assert counted == {tuple(r) for r in industry_od(trips, inputs.bases, P).collect()}
    for name, source in (("yellow", "yellow"), ("green", "green"), ("no_hv", "fhv"), ("hvfhv", "hvfhv")):
        t = trips[source].where(f"datetimeid >= {start} AND datetimeid < {end}")
        assert seen[name]["trips"] == t.count() > 0
        assert seen[name]["no_pickup"] == t.where("pulocationid IS NULL").count() > 0
        assert seen[name]["no_dropoff"] == t.where("dolocationid IS NULL").count()
    hv = trips["hvfhv"].where(f"datetimeid >= {start} AND datetimeid < {end}")
    assert seen["hvfhv"]["shared"] == hv.where("route_id IS NOT NULL").count() > 0
    assert seen["hvfhv"]["dropped"] == hv.where("NOT (trip_miles > 0 AND base_passenger_fare > 0)").count()
    assert "dropped" not in seen["no_hv"]
    assert seen["od"] == {"rows": len(counted), "trips": sum(r[4] for r in counted), "companies": sorted({r[3] for r in counted})}
