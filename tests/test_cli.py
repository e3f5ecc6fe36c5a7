"""End to end on a production-style layout: trip files, base list, lookup and the
zone-matrix CSV on disk -> ``python -m farezone`` -> the published mart equals
the trips mart and zone financials computed in memory."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from farezone.__main__ import main
from farezone.config import fixture_params
from farezone.plans.financials import zone_financials_mart
from farezone.plans.inputs import TripInputs
from farezone.plans.trips import trips_mart
from farezone.sources import fixtures
from farezone.sources.readers import read_mart

from conftest import SF_SMALL


def test_cli_monthly_run_on_files(spark):
    root = tempfile.mkdtemp(prefix="prod-")
    for name, build in fixtures.TRIP_VIEWS.items():
        build(spark, SF_SMALL).write.parquet(f"{root}/{name}")
    fixtures.bases(spark, SF_SMALL).write.parquet(f"{root}/bases")
    fixtures.zone_lookup(spark, SF_SMALL).write.parquet(f"{root}/lookup")
    fixtures.zone_matrix(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(f"{root}/idall")
    out = f"{root}/published"
    asof = dt.date(2001, 1, 15)
    main(["--yellow", f"{root}/yellow", "--green", f"{root}/green", "--fhv", f"{root}/fhv",
          "--hvfhv", f"{root}/hvfhv", "--bases", f"{root}/bases", "--zone-matrix", f"{root}/idall",
          "--zone-lookup", f"{root}/lookup", "--out", out, "--asof", asof.isoformat(),
          "--start", "1996010100", "--end", "2001010100", "--all-since", "1998-06-01",
          "--fare-cap", "100000", "--distance-cap", "45"])

    # the same run in memory, with the fixture parameters
    inputs = TripInputs.from_paths(
        spark, {n: f"{root}/{n}" for n in fixtures.TRIP_VIEWS}, f"{root}/bases", f"{root}/idall",
        f"{root}/lookup")
    params = fixture_params()
    assert params.asof == asof
    expect = (trips_mart(inputs, params).withColumn("count", F.col("count").cast("double"))
              .unionByName(zone_financials_mart(inputs, params)))
    got = read_mart(spark, f"{out}/trips_updated")
    n = got.count()
    assert n > 10000 and n == expect.count()
    assert {r.metric for r in got.select("metric").distinct().collect()} == {
        "Trips", "PickUps", "DropOffs", "Average Fare", "Total Fare", "Average Trip Time",
        "Average Trip Distance"}
    assert got.exceptAll(expect.select(*got.columns)).count() == 0
