"""Sinks and readers: idempotent mart extension, history splice, interim tables,
the zone matrix CSV with CRLF line ends."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from farezone.operators.zones import zone_members
from farezone.sources.readers import MART_SCHEMA, read_mart, read_zone_matrix
from farezone.sources.sinks import extend_mart, splice_history, write_csv, write_interim


def _mart_rows(spark, metric, value):
    rows = [(dt.date(2000, 1, 1), 1, "YELLOW", "Core", "Z1", metric, value)]
    return spark.createDataFrame(rows, MART_SCHEMA)


def test_extend_mart_is_idempotent(spark):
    out = tempfile.mkdtemp(prefix="mart-")
    extend_mart(_mart_rows(spark, "Trips", 5.0), out)
    extend_mart(_mart_rows(spark, "Average Fare", 12.5), out)
    extend_mart(_mart_rows(spark, "Average Fare", 12.5), out)   # second run: no duplicates
    m = read_mart(spark, out)
    got = sorted((r.metric, r["count"]) for r in m.collect())
    assert got == [("Average Fare", 12.5), ("Trips", 5.0)]
    extend_mart(_mart_rows(spark, "Trips", 6.0), out)            # replaces only Trips
    got = sorted((r.metric, r["count"]) for r in read_mart(spark, out).collect())
    assert got == [("Average Fare", 12.5), ("Trips", 6.0)]


def test_splice_history_filters_both_sides(spark):
    hist = spark.createDataFrame([(dt.date(2000, 1, 1), 1), (dt.date(2000, 2, 1), 2)], "year_month date, v int")
    new = spark.createDataFrame([(dt.date(2000, 2, 1), 20), (dt.date(2000, 3, 1), 30)], "year_month date, v int")
    got = sorted(tuple(r) for r in splice_history(hist, new, dt.date(2000, 2, 1)).collect())
    assert got == [(dt.date(2000, 1, 1), 1), (dt.date(2000, 2, 1), 20), (dt.date(2000, 3, 1), 30)]


def test_write_interim_cuts_lineage(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    back = write_interim(df, "t")
    assert back.count() == 100
    plan = back._jdf.queryExecution().analyzed().toString()
    assert "Range" not in plan


def test_zone_matrix_csv_with_crlf(spark):
    d = tempfile.mkdtemp(prefix="zm-")
    p = os.path.join(d, "idall.csv")
    with open(p, "wb") as f:
        f.write(b"ID,Citywide,Core,Airports\r\n1,Yes,No,Yes\r\n2,Yes,Yes,No\r\n")
    m = read_zone_matrix(spark, p)
    assert m.columns == ["ID", "Citywide", "Core", "Airports"]
    got = sorted(tuple(r) for r in zone_members(m).collect())
    assert got == [(1, "Airports"), (1, "Citywide"), (2, "Citywide"), (2, "Core")]


def test_write_csv_has_header_and_no_index(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="csv-"), "t")
    out = write_csv(spark.createDataFrame([(1, "a")], "id int, v string"), out, order_by=["id"])
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.endswith(".csv"))
    assert text.splitlines()[0] == "id,v"
