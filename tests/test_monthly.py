"""The monthly run writes every output; a rerun leaves the same tables; an
incremental run (only months from a date on) leaves the same tables too, and its
trip scans start at that month."""

import datetime as dt
import re
import tempfile

from farezone.config import fixture_params, since
from farezone.plans.inputs import TripInputs
from farezone.plans.monthly import run_monthly
from farezone.plans.slice import mart_slice
from farezone.plans.trips import trips_mart
from farezone.sources.published import read_published
from farezone.sources.readers import read_mart

from conftest import SF_SMALL


def test_monthly_run_and_incremental_rerun(spark):
    out = tempfile.mkdtemp(prefix="monthly-")
    params = fixture_params()
    inputs = TripInputs.from_fixtures(spark, SF_SMALL)
    paths = run_monthly(inputs, params, out)
    assert set(paths) == {"trips_updated", "yellow_fare", "yellow_fare_melt", "green_fare",
                          "green_fare_melt", "hvfhv_fare", "hvfhv_fare_melt", "fhv3"}

    def snapshot():
        mart = sorted(tuple(r) for r in read_mart(spark, paths["trips_updated"]).collect())
        fares = {t: sorted(tuple(r) for r in read_published(spark, paths[t]).collect())
                 for t in ("yellow_fare", "green_fare_melt", "hvfhv_fare")}
        return mart, fares

    first = snapshot()

    # C8 on the published mart: metric and month filters prune partition folders
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    sl = mart_slice(read_mart(spark, paths["trips_updated"]), "Trips", zones=["Core"],
                    start=dt.date(1999, 1, 1), end=dt.date(2000, 1, 1))
    plan = sl._jdf.queryExecution().executedPlan().toString()
    pf = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "metric" in pf and "year_month" in pf
    got = sl.collect()
    assert got and all(r.metric == "Trips" and r.Z == "Core" and dt.date(1999, 1, 1) <= r.year_month
                       < dt.date(2000, 1, 1) for r in got)
    assert {r[5] for r in first[0]} == {"Trips", "PickUps", "DropOffs", "Average Fare", "Total Fare",
                                        "Average Trip Time", "Average Trip Distance"}
    assert len(first[1]["yellow_fare"]) > 0

    # incremental rerun over the published tables: replaces months from 2000-06 on,
    # leaves the earlier ones; the tables are the same (S9 idempotency: test_sinks)
    run_monthly(inputs, params, out, since=dt.date(2000, 6, 1))
    assert snapshot() == first


def test_incremental_scans_start_at_since(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    inputs = TripInputs.from_fixtures(spark, SF_SMALL)
    mart = trips_mart(inputs, since(fixture_params(), dt.date(2000, 6, 1)), interim=False)
    p = mart._jdf.queryExecution().executedPlan().toString()
    scans = [s for s in re.findall(r"FileScan parquet [^\n]*", p) if "datetimeid" in s]
    assert len(scans) == 4
    assert all(re.search(r"datetimeid#\d+L >= 2000060100", s) for s in scans)
