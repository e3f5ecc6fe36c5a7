"""Small units: run bounds, month keys, labels, F8 NULL rule, readers S2/S4."""

import datetime as dt
import tempfile


from farezone.functions.labels import label_company, license_to_company, to_sector
from farezone.functions.timekeys import hour_key, month_date, month_key, run_bounds
from farezone.operators.joins import not_in_zone
from farezone.sources.readers import read_bases, read_zone_names, zone_names


def test_run_bounds():
    assert run_bounds(dt.date(2022, 6, 25)) == (dt.date(2022, 5, 1), 2022050100)
    assert run_bounds(dt.date(2001, 1, 15)) == (dt.date(2000, 12, 1), 2000120100)
    assert run_bounds(dt.date(2020, 1, 1)) == (dt.date(2019, 12, 1), 2019120100)


def test_time_keys(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 2, 3, 17, 5),)], "ts timestamp_ntz")
    r = (df.select(hour_key("ts").alias("h"))
           .select("h", month_key("h").alias("ym"))
           .select("h", "ym", month_date("ym").alias("d")).first())
    assert (r.h, r.ym, r.d) == (2019020317, 201902, dt.date(2019, 2, 1))


def test_labels(spark):
    df = spark.createDataFrame([("HV0002",), ("HV0003",), ("HV0006",), (None,)], "c string")
    got = [r[0] for r in df.selectExpr(license_to_company("c")).collect()]
    assert got == ["JUNO", "UBER", "HV0006", None]
    df = spark.createDataFrame([("no_hv",), ("yellow",), ("base co",), ("LYFT",)], "c string")
    got = [r[0] for r in df.selectExpr(to_sector(label_company("c"))).collect()]
    assert got == ["FHV", "YELLOW", "BASECO", "HVFHV"]


def test_not_in_zone_keeps_null_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "pulocationid int")
    members = spark.createDataFrame([(1, "Core")], "id int, zone string")
    got = sorted((r[0] is None, r[0]) for r in not_in_zone(df, members, "pulocationid").collect())
    assert got == [(False, 2), (True, None)]


def test_bases_and_zone_names_readers(spark):
    d = tempfile.mkdtemp(prefix="dims-")
    spark.createDataFrame([("B1", "UBER")], "lic_no string, company string").write.parquet(f"{d}/bases")
    spark.createDataFrame([(1, "Newark Airport")], "LocationID int, Zone string").write.parquet(f"{d}/lookup")
    assert [tuple(r) for r in read_bases(spark, f"{d}/bases").collect()] == [("B1", "UBER")]
    assert [tuple(r) for r in zone_names(read_zone_names(spark, f"{d}/lookup")).collect()] == [(1, "Newark Airport")]
