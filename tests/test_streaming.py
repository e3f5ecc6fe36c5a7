"""The incremental refresh equals the batch OD counts, across several micro-batches
and a rerun (exactly-once), and the by-month relayout prunes folders."""

import re
import tempfile

from pyspark.sql import functions as F

from farezone.config import fixture_params
from farezone.operators.aggregates import filtered_trips, od_counts
from farezone.sources import fixtures
from farezone.sources.sinks import relayout_by_month
from farezone.streaming.refresh import read_od, start_od_refresh

from conftest import SF_SMALL

P = fixture_params()


def test_refresh_matches_batch_and_is_exactly_once(spark):
    ind = P.industry("yellow")
    src = tempfile.mkdtemp(prefix="trips-")
    yellow = fixtures.yellow(spark, SF_SMALL)
    # several files, each holding a range of months, as monthly deliveries would
    for y in range(1995, 2002):
        (yellow.filter(F.expr(f"datetimeid div 1000000 = {y}")).coalesce(1)
               .write.mode("append").parquet(src))
    out, ckpt = tempfile.mkdtemp(prefix="od-"), tempfile.mkdtemp(prefix="ckpt-")
    q = start_od_refresh(spark, src, "yellow", ind, ind.trips_start, P.trips_end, out, ckpt,
                         max_files_per_trigger=2)
    q.awaitTermination(300)
    # rerun: no new files, nothing counted twice
    q2 = start_od_refresh(spark, src, "yellow", ind, ind.trips_start, P.trips_end, out, ckpt)
    q2.awaitTermination(300)
    got = {tuple(r) for r in read_od(spark, out).collect()}
    want = {tuple(r) for r in od_counts(filtered_trips(yellow, ind, ind.trips_start, P.trips_end)).collect()}
    assert len(want) > 100
    assert got == want
    assert spark.read.parquet(out).select("batch").distinct().count() >= 2


def test_relayout_prunes_month_folders(spark):
    out = tempfile.mkdtemp(prefix="relayout-") + "/yellow"
    relayout_by_month(fixtures.yellow(spark, SF_SMALL), out)
    df = spark.read.parquet(out).filter(F.col("year_month") == 199903)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*year_month", p)
    assert df.count() == fixtures.yellow(spark, SF_SMALL).filter(F.expr("datetimeid div 10000 = 199903")).count()


def test_refresh_traditional_fhv_with_bases(spark):
    from farezone.operators.aggregates import od_counts_traditional
    from farezone.streaming.refresh import traditional_od

    ind = P.industry("no_hv")
    src = tempfile.mkdtemp(prefix="fhv-")
    fhv = fixtures.fhv(spark, SF_SMALL)
    fhv.write.mode("overwrite").parquet(src)
    bases = fixtures.bases(spark, SF_SMALL)
    out, ckpt = tempfile.mkdtemp(prefix="od-"), tempfile.mkdtemp(prefix="ckpt-")
    q = start_od_refresh(spark, src, "fhv", ind, ind.trips_start, P.trips_end, out, ckpt,
                         od=traditional_od(bases, ind.trips_start, P.trips_end))
    q.awaitTermination(300)
    got = {tuple(r) for r in read_od(spark, out).collect()}
    want = {tuple(r) for r in od_counts_traditional(fhv, bases, ind.trips_start, P.trips_end).collect()}
    assert len(want) > 10 and got == want
