"""O1-O3 where they count: the order of rows in the files that are published, and the slice's
partition filters."""

import datetime as dt
import glob
import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from farezone.config import fixture_params
from farezone.plans.inputs import TripInputs
from farezone.plans.monthly import run_monthly
from farezone.sources.sinks import publish

from conftest import SF_SMALL


def _lines(folder):
    rows = []
    for f in sorted(glob.glob(f"{folder}/**/part-*.csv", recursive=True)):
        header, *body = open(f).read().splitlines()
        rows += [dict(zip(header.split(","), line.split(","))) for line in body]
    return rows


def test_published_files_are_sorted(spark):
    out = tempfile.mkdtemp(prefix="order-")
    run_monthly(TripInputs.from_fixtures(spark, SF_SMALL), fixture_params(), out, fmt="csv")
    for table in ("yellow_fare", "green_fare_melt", "fhv3"):  # O1: newest month first
        months = [r["year_month"] for r in _lines(f"{out}/{table}")]
        assert len(months) > 12 and months == sorted(months, reverse=True)
    for folder in glob.glob(f"{out}/trips_updated/version=*/metric=*/year_month=*"):
        rows = [(int(r["id"]), r["company"], r["Z"]) for r in _lines(folder)]
        if re.search("metric=(Trips|PickUps|DropOffs)/", folder):  # O3
            assert rows == sorted(rows)
        else:  # O2: a folder is a month; company, then zone, descending
            assert [(c, z) for _, c, z in rows] == sorted(((c, z) for _, c, z in rows), reverse=True)


def test_the_registered_slice_prunes_folders(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = E.queries()["mart_slice"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "metric" in filters and "year_month" in filters


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_partition_of_several_files_keeps_its_order(spark, fmt):
    """O2, O3 past one task: file names follow the order of the rows, up and down."""
    path = tempfile.mkdtemp(prefix="spread-") + "/t"
    r = random.Random(8)
    rows = [(dt.date(2000, m, 1), metric, r.randrange(500), r.choice("ABC"), float(i))
            for m in (1, 2) for metric in ("Trips", "Average Fare") for i in range(2000 if m == 1 else 30)]
    df = spark.createDataFrame(rows, "year_month date, metric string, id int, company string, count double").repartition(5)
    up = F.col("metric") == "Trips"
    order = [F.when(up, F.col("id")), F.desc("company"), F.desc("id")]
    publish(df, path, ("metric", "year_month"), fmt, order, spread=16)
    got = []
    for folder in glob.glob(f"{path}/version=*/metric=*/year_month=*"):
        files = sorted(glob.glob(f"{folder}/part-*"))
        if "year_month=2000-01" in folder:
            assert len(files) >= 4
        held = []
        for f in files:
            reader = spark.read.schema("id int, company string, count double").option("header", True)
            held += [(x.id, x.company) for x in reader.format(fmt).load(f).collect()]  # one small file is one task
        if "metric=Trips" in folder:
            assert held == sorted(held, key=lambda x: (x[0], -ord(x[1])))
        else:
            assert held == sorted(held, key=lambda x: (-ord(x[1]), -x[0]))
        got += held
    assert sorted(got) == sorted((x[2], x[3]) for x in rows)
