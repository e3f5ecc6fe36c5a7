"""Reading files with their own types, run bounds, the mart's tail, and reruns that
publish fewer months than before."""

import datetime as dt
import os
import tempfile
import uuid
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from farezone.config import Params, fixture_params, since
from farezone.operators.aggregates import od_counts_traditional
from farezone.plans.inputs import TripInputs
from farezone.plans.monthly import run_monthly
from farezone.plans.trips import finish_mart
from farezone.sources import fixtures, readers
from farezone.sources.published import read_published
from farezone.sources.readers import read_mart, read_trips
from farezone.sources.sinks import publish, shared_dir

from conftest import SF_SMALL


def _yellow_file(spark, path, ids, money):
    df = spark.createDataFrame([(2022050112, 5, 7, 1.5, 600, 180.25, 20.0, 150.0)],
                               "datetimeid long, pulocationid int, dolocationid int, trip_distance double, trip_time_in_secs int, "
                               "total_amount double, fare_amount double, tip_amount double")
    df = df.withColumns({c: F.col(c).cast(ids) for c in ("pulocationid", "dolocationid", "trip_time_in_secs")})
    df = df.withColumns({c: F.col(c).cast(money) for c in ("total_amount", "fare_amount", "tip_amount")})
    df.write.parquet(path)


@pytest.mark.parametrize("ids", ["int", "bigint", "smallint"])
@pytest.mark.parametrize("money", ["double", "decimal(12,2)", "decimal(6,2)", "float"])
def test_trip_files_of_any_physical_type(spark, ids, money):
    path = tempfile.mkdtemp(prefix="types-") + "/t"
    _yellow_file(spark, path, ids, money)
    df = read_trips(spark, path, "yellow")
    r = df.first()
    assert (r.pulocationid, r.trip_time_in_secs, r.total_amount, r.tip_amount) == (5, 600, Decimal("180.25"), Decimal("150.00"))
    assert r.airport_fee is None and r.hack_number is None  # not in the file
    assert df.schema["tip_amount"].dataType.simpleString() == "decimal(12,2)"
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = df.filter("datetimeid >= 2022050100").select("tip_amount")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(datetimeid,2022050100)" in plan


def test_a_value_that_does_not_fit_fails_the_read(spark):
    for col, value, kind in (("pulocationid", 2 ** 40, "long"), ("pulocationid", 1.5, "double"), ("total_amount", 1e12, "double")):
        path = tempfile.mkdtemp(prefix="loss-") + "/t"
        spark.createDataFrame([(2022050112, value)], f"datetimeid long, {col} {kind}").write.parquet(path)
        with pytest.raises(Exception, match="doesn't fit"):
            read_trips(spark, path, "yellow").collect()


def test_each_month_has_the_columns_and_types_of_its_own_file(spark):
    for kind in ("int", "bigint"):  # schemas that merge, and that don't
        path = tempfile.mkdtemp(prefix="months ")
        spark.createDataFrame([(2018010112, 5)], "datetimeid long, pulocationid int").write.parquet(f"{path}/m=1")
        spark.createDataFrame([(2019020112, 6, 3.75, 2.5)], f"datetimeid long, pulocationid {kind}, Airport_fee double, congestion_surcharge double"
                              ).write.parquet(f"{path}/m=2")
        spark.createDataFrame([(2020030112, 7, 1.25)], f"datetimeid long, pulocationid {kind}, airport_fee double").write.parquet(f"{path}/m=3")
        for where in (path, f"{path}/m=[123]/*.parquet"):
            got = sorted((r.datetimeid, r.pulocationid, r.airport_fee, r.congestion_surcharge) for r in read_trips(spark, where, "yellow").collect())
            assert got == [(2018010112, 5, None, None), (2019020112, 6, Decimal("3.75"), Decimal("2.50")),
                           (2020030112, 7, Decimal("1.25"), None)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_trips(spark, f"{path}/none", "yellow")


def test_run_bounds_follow_the_run_date():
    p = Params(asof=dt.date(2023, 5, 25))
    assert p.trips_end == 2023040100 and p.industry("yellow").financials_end == 0
    q = since(p, dt.date(2023, 3, 1))
    assert q.industry("hvfhv").trips_start == 2023030100 and q.trips_end == 2023040100
    only_end = p.with_period(end=2022060100)
    assert only_end.trips_end == 2022060100 and only_end.industry("yellow").trips_start == 2011010100
    only_start = p.with_period(start=2020010100)
    assert only_start.trips_end == 2023040100 and only_start.industry("green").financials_start == 2020010100


def test_since_run_with_derived_bounds_publishes_its_months(spark):
    inputs = TripInputs.from_fixtures(spark, SF_SMALL)
    params = replace(fixture_params(), trips_end=0)
    params = replace(params, industries={n: replace(i, financials_end=0) for n, i in params.industries.items()})
    out = tempfile.mkdtemp(prefix="since-")
    run_monthly(inputs, params, out, since=dt.date(2000, 9, 1))
    mart = read_mart(spark, f"{out}/trips_updated")
    months = {(r.metric, r.year_month) for r in mart.select("metric", "year_month").distinct().collect()}
    assert {m for k, m in months if k == "Trips"} == {dt.date(2000, 9, 1), dt.date(2000, 10, 1), dt.date(2000, 11, 1)}
    assert {m for k, m in months if k == "Average Fare"} == {dt.date(2000, 9, 1), dt.date(2000, 10, 1), dt.date(2000, 11, 1)}


def test_mart_tail_null_and_repeated_names(spark):
    rows = [(dt.date(1999, 1, 1), i, "YELLOW", "Citywide", "Trips", 5) for i in (1, 2, 3, 4)]
    combined = spark.createDataFrame(rows, "year_month date, id int, company string, Z string, metric string, count long")
    names = spark.createDataFrame([(1, None), (2, "Z2"), (3, "Z3"), (3, "Z3"), (3, "Other")], "id int, zone string")
    got = sorted((r.id, r.company, r.Zone, r["count"]) for r in finish_mart(combined, names, fixture_params()).collect())
    assert got == [(2, "ALL", "Z2", 5), (2, "YELLOW", "Z2", 5), (3, "ALL", "Other", 5), (3, "ALL", "Z3", 10),
                   (3, "YELLOW", "Other", 5), (3, "YELLOW", "Z3", 10)]


def test_reruns_leave_no_withdrawn_month(spark):
    def table(months):
        return spark.createDataFrame([(dt.date(2000, m, 1), "Trips", float(v)) for m, v in months.items()],
                                     "year_month date, metric string, count double")

    def rows(path):
        return sorted((x.year_month.month, x["count"]) for x in read_published(spark, path, table({}).schema).collect())

    for fmt in ("parquet", "csv"):
        path = tempfile.mkdtemp(prefix="rerun-") + "/t"
        publish(table({1: 1, 2: 2, 3: 3}), path, ("metric", "year_month"), fmt)
        publish(table({1: 10, 2: 20}), path, ("metric", "year_month"), fmt)
        assert rows(path) == [(1, 10.0), (2, 20.0)]
        publish(table({1: 1, 2: 2, 3: 3, 4: 4}), path, ("metric", "year_month"), fmt)
        publish(table({3: 30}), path, ("metric", "year_month"), fmt, since=dt.date(2000, 3, 1))
        assert rows(path) == [(1, 1.0), (2, 2.0), (3, 30.0)]


def test_monthly_run_as_csv_and_with_an_earlier_date(spark):
    inputs = TripInputs.from_fixtures(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="csv-run-")
    params = fixture_params()
    run_monthly(inputs, params, out, fmt="csv")
    mart = read_mart(spark, f"{out}/trips_updated", fmt="csv")
    last = mart.agg(F.max("year_month")).first()[0]
    assert last == dt.date(2000, 11, 1) and mart.filter("Zone is null and metric = 'Trips'").count() == 0
    run_monthly(inputs, replace(params, asof=dt.date(2000, 8, 15)), out, fmt="csv")
    assert read_mart(spark, f"{out}/trips_updated", fmt="csv").agg(F.max("year_month")).first()[0] == dt.date(2000, 6, 1)
    interim = f"{shared_dir(spark)}/interim".removeprefix("file:")
    before = set(os.listdir(interim))
    run_monthly(inputs, replace(params, asof=dt.date(2000, 8, 15)), out, fmt="csv", since=dt.date(2000, 5, 1))
    assert set(os.listdir(interim)) == before  # what the run wrote in between is gone
    assert read_mart(spark, f"{out}/trips_updated", fmt="csv").agg(F.max("year_month")).first()[0] == dt.date(2000, 6, 1)
    fares = read_published(spark, f"{out}/yellow_fare")
    assert max(r.year_month for r in fares.collect()) == "2000-06-01"


def test_base_join_has_one_shuffle_of_zone_pairs(spark):
    """The rows that reach the exchange are the partial sums by zone pair, not the trips."""
    inputs = TripInputs(fhv=fixtures.fhv(spark, SF_SMALL), bases=fixtures.bases(spark, SF_SMALL))
    od = od_counts_traditional(inputs.fhv, inputs.bases, 1996010100, 2001010100)
    plan = od._jdf.queryExecution().executedPlan().toString()
    above_join = plan.split("BroadcastHashJoin Inner BuildRight")[0]
    assert above_join.count("Exchange hashpartitioning(year_month") <= 1 and "dispatching_base_num" not in above_join.split("Exchange")[0]


def _typed_files(spark, n):
    """Folders of ``n`` files each of four kinds, interleaved by name: ids as int or bigint, money as
    double or decimal, one kind without a fee."""
    path = tempfile.mkdtemp(prefix="kinds-")
    rows = spark.range(4 * n).withColumn("kind", F.col("id") % 4)
    for kind, (ids, money) in enumerate([("int", "double"), ("bigint", "double"), ("int", "decimal(10,2)"), ("bigint", "double")]):
        df = (rows.where(F.col("kind") == kind)
              .select((F.lit(2020010100) + F.col("id") % 24).alias("datetimeid"), (F.col("id") % 265).cast(ids).alias("pulocationid"),
                      (F.col("id") / 4).cast(money).alias("total_amount"), F.lit(0.25).alias("Airport_Fee")))
        (df if kind != 3 else df.drop("Airport_Fee")).repartition(n).write.parquet(f"{path}/kind={kind}")
    return path


def _jobs(spark, run):
    spark.sparkContext.setJobGroup(group := f"jobs-{uuid.uuid4().hex}", "counted")
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_mixed_files_take_a_constant_number_of_jobs(spark):
    counts = {}
    for n in (60, 500):  # both above the number of paths that Spark lists in a job
        path = _typed_files(spark, n)
        df, counts[n] = _jobs(spark, lambda: read_trips(spark, path, "yellow"))
        got = df.agg(F.count("*").alias("n"), F.sum("total_amount").alias("t"), F.sum("airport_fee").alias("f"),
                     F.count_distinct("pulocationid").alias("ids")).first()
        assert (got.n, got.ids) == (4 * n, min(265, 4 * n))
        assert float(got.t) == pytest.approx(sum(round(i / 4, 2) for i in range(4 * n))) and float(got.f) == 0.25 * 3 * n
        scans = df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
        assert scans == 3  # the files without a fee go with those of the same types
    assert counts[500] == counts[60] <= 10


def test_files_that_python_cannot_open_are_grouped_by_spark(spark, monkeypatch):
    path = _typed_files(spark, 2)
    want = sorted(map(str, read_trips(spark, path, "yellow").collect()))
    monkeypatch.setattr(readers, "footer_types", lambda spark, files, names: [(f, None) for f in files])
    assert sorted(map(str, read_trips(spark, path, "yellow").collect())) == want


def test_only_a_conflict_of_types_is_worked_around(spark):
    path = tempfile.mkdtemp(prefix="broken-")
    spark.range(1).withColumnRenamed("id", "datetimeid").write.parquet(f"{path}/a")
    with open(f"{path}/a/part-x.parquet", "wb") as f:
        f.write(b"not a Parquet file")
    with pytest.raises(Exception, match="not a Parquet file"):
        read_trips(spark, f"{path}/a", "yellow")
