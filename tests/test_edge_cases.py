"""Hand-made cases, a few rows each, for the NULL and boundary rules (SURVEY 2.11,
2.12, 2.14): NULL pickup / drop-off / company, unknown licence, id without a
name, id in several zones, drop-off-only key, zero drivers, all-NULL measure,
period and cutoff boundaries, duplicate base licence."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from farezone import config as C
from farezone.config import fixture_params
from farezone.operators import aggregates as A
from farezone.operators.fares import fare_trips, monthly_fares
from farezone.operators.joins import duplicate_keys, trips_with_base
from farezone.operators.zones import inbound, zone_volume
from farezone.plans import trips as TP
from farezone.plans.financials import zone_financials_mart
from farezone.plans.inputs import TripInputs
from farezone.sources.readers import TRIP_SCHEMAS, ZONE_NAMES_SCHEMA

P = fixture_params()
HK = 1999031500  # an hour key inside the fixture period (March 1999)


def trips(spark, industry, rows):
    """Trip rows as dicts; unspecified columns are NULL except sane measures."""
    schema = TRIP_SCHEMAS[industry]
    defaults = {"trip_distance": 1.0, "total_amount": Decimal("10.00"), "fare_amount": Decimal("8.00"),
                "trip_time_in_secs": 600, "trip_miles": 1.0, "base_passenger_fare": Decimal("10.00"),
                "trip_time": 600, "hack_number": "D1", "tlc_driver_license_num": "D1"}
    full = []
    for r in rows:
        d = {f.name: r.get(f.name, defaults.get(f.name)) for f in schema.fields}
        full.append(tuple(d[f.name] for f in schema.fields))
    return spark.createDataFrame(full, schema)


def matrix(spark):
    """ids 1..4: 1 in Core+Midtown+Airports, 2 in Core, 3 in Non_Core, 4 in no zone but Citywide."""
    rows = [(1, "Yes", "Yes", "Yes", "No", "Yes"), (2, "Yes", "Yes", "No", "No", "No"),
            (3, "Yes", "No", "No", "Yes", "No"), (4, "Yes", "No", "No", "No", "No")]
    cols = ["ID", "Citywide", "Core", "Midtown", "Non_Core", "Airports"]
    return spark.createDataFrame(rows, cols).withColumn("ID", F.col("ID").cast("int"))


def lookup(spark, ids=(1, 2, 3)):
    return spark.createDataFrame([(i, f"Z{i}") for i in ids], ZONE_NAMES_SCHEMA)


def od(spark, rows):
    s = T.StructType([T.StructField("year_month", T.LongType()), T.StructField("pulocationid", T.IntegerType()),
                      T.StructField("dolocationid", T.IntegerType()), T.StructField("company", T.StringType()),
                      T.StructField("count", T.LongType())])
    return spark.createDataFrame(rows, s)


def rows_set(df):
    return {tuple(r) for r in df.collect()}


# -- A1 / A5 with NULL ids ----------------------------------------------------------

def test_null_ids_group_in_od_but_not_in_marginals(spark):
    t = trips(spark, "yellow", [{"datetimeid": HK, "pulocationid": None, "dolocationid": 2},
                                {"datetimeid": HK, "pulocationid": 1, "dolocationid": None},
                                {"datetimeid": HK, "pulocationid": 1, "dolocationid": None}])
    o = A.od_counts(t)
    assert rows_set(o) == {(199903, None, 2, 1), (199903, 1, None, 2)}
    o = o.withColumn("company", F.lit("yellow"))
    assert rows_set(A.pickups(o).select("id", "count")) == {(1, 2)}
    assert rows_set(A.dropoffs(o).select("id", "count")) == {(2, 1)}


def test_period_boundaries_half_open(spark):
    ind = P.industry("yellow")
    t = trips(spark, "yellow", [{"datetimeid": ind.trips_start, "pulocationid": 1, "dolocationid": 1},
                                {"datetimeid": P.trips_end, "pulocationid": 1, "dolocationid": 1},
                                {"datetimeid": 2000123123, "pulocationid": 1, "dolocationid": 1},
                                {"datetimeid": HK, "pulocationid": 1, "dolocationid": 1, "trip_distance": 0.0},
                                {"datetimeid": HK, "pulocationid": 1, "dolocationid": 1, "total_amount": None}])
    got = A.od_counts(A.filtered_trips(t, ind, ind.trips_start, P.trips_end))
    assert rows_set(got) == {(199601, 1, 1, 1), (200012, 1, 1, 1)}


# -- J1 / A2 / A4: bases --------------------------------------------------------------

def test_base_join_null_company_and_duplicate_licence(spark):
    fhv = trips(spark, "fhv", [{"datetimeid": HK, "pulocationid": 1, "dolocationid": 2, "dispatching_base_num": "B1"},
                               {"datetimeid": HK, "pulocationid": 1, "dolocationid": 2, "dispatching_base_num": "B2"},
                               {"datetimeid": HK, "pulocationid": 1, "dolocationid": 2, "dispatching_base_num": "B3"},
                               {"datetimeid": HK, "pulocationid": 1, "dolocationid": 2, "dispatching_base_num": "B9"}])
    bases = spark.createDataFrame([("B1", "BASE CO"), ("B1", "BASE CO"), ("B2", None), ("B3", "UBER")],
                                  "lic_no string, company string")
    # duplicate B1 doubles its trip; NULL company (B2) is dropped by NOT IN; B9 has no base
    trad = A.od_counts_traditional(fhv, bases, 1996010100, 2001010100)
    assert rows_set(trad) == {(199903, 1, 2, 2)}
    old = A.od_counts_old_hv(fhv, bases, 1996010100, 2001010100)
    assert rows_set(old) == {(199903, 1, 2, "UBER", 1)}
    assert rows_set(trips_with_base(fhv, bases).select("dispatching_base_num", "company")) == {
        ("B1", "BASE CO"), ("B2", None), ("B3", "UBER")}
    assert trips_with_base(fhv, bases).count() == 4
    assert rows_set(duplicate_keys(bases, "lic_no")) == {("B1", 2)}


# -- J2 / A6: zone volume -------------------------------------------------------------

def test_zone_volume_rules(spark):
    m, city = matrix(spark), (C.CITYWIDE,)
    o = od(spark, [
        (199903, 1, 2, "X", 5),     # inside Core both ends: pickup at 1 only
        (199903, 3, 2, "X", 7),     # Non_Core -> Core: inbound to 2 in Core
        (199903, None, 1, "X", 4),  # unknown pickup -> counts as outside everywhere
        (199903, 2, 1, "X", 1),     # pickup at 2 (Core); 1 is in Core too, so not inbound to Core
        (199904, 3, 1, "X", 9),     # drop-off at 1 in April, no pickup at 1 in April
    ])
    vol = {(r.year_month, r.id, r.zone): (r["count"], r.count1, r.volume) for r in zone_volume(o, m, city).collect()}
    assert vol[(199903, 1, "Core")] == (5, 4, 9)          # 5 picked up + 4 unknown-start inbound
    assert vol[(199903, 1, "Midtown")] == (5, 5, 10)      # 4 unknown + 1 from 2 (2 not in Midtown)
    assert vol[(199903, 1, "Airports")] == (5, 5, 10)
    assert vol[(199903, 2, "Core")] == (1, 7, 8)          # 1 picked up; 7 from Non_Core
    assert vol[(199903, 3, "Non_Core")] == (7, 0, 7)
    assert (199904, 1, "Core") not in vol                 # drop-off only: no row
    assert vol[(199904, 3, "Non_Core")] == (9, 0, 9)
    inb = {(r.year_month, r.id, r.zone): r.count1 for r in inbound(o, m, city).collect()}
    assert inb[(199904, 1, "Core")] == 9                  # inbound still reported on its own


def test_zone_volume_equals_pickups_when_no_inbound(spark):
    m, city = matrix(spark), (C.CITYWIDE,)
    o = od(spark, [(199903, 1, 1, "X", 3), (199903, 3, 3, "X", 2)])
    assert rows_set(zone_volume(o, m, city).select("id", "zone", "volume")) == {
        (1, "Core", 3), (1, "Midtown", 3), (1, "Airports", 3), (3, "Non_Core", 2)}


# -- C4: trips mart ---------------------------------------------------------------------

def _mart_inputs(spark, yellow_rows=(), hv_rows=(), fhv_rows=(), bases_rows=()):
    empty = {"datetimeid": HK, "pulocationid": 1, "dolocationid": 1}
    return TripInputs(
        yellow=trips(spark, "yellow", list(yellow_rows)) if yellow_rows else trips(spark, "yellow", [empty]).limit(0),
        green=trips(spark, "green", [empty]).limit(0),
        fhv=trips(spark, "fhv", list(fhv_rows)) if fhv_rows else trips(spark, "fhv", [empty]).limit(0),
        hvfhv=trips(spark, "hvfhv", list(hv_rows)) if hv_rows else trips(spark, "hvfhv", [empty]).limit(0),
        bases=spark.createDataFrame(list(bases_rows) or [("B0", "BASE CO")], "lic_no string, company string"),
        zone_matrix=matrix(spark),
        zone_lookup=lookup(spark),
    )


def test_mart_labels_unknown_licence_and_unnamed_id(spark):
    hv = [{"datetimeid": HK, "pulocationid": 1, "dolocationid": 1, "hvfhs_license_num": "HV0003"},
          {"datetimeid": HK, "pulocationid": 1, "dolocationid": 1, "hvfhs_license_num": "HV0005"},
          {"datetimeid": HK, "pulocationid": 1, "dolocationid": 1, "hvfhs_license_num": "HV0009",
           "route_id": 7},
          {"datetimeid": HK, "pulocationid": 4, "dolocationid": 4, "hvfhs_license_num": "HV0003"}]
    mart = TP.trips_mart(_mart_inputs(spark, hv_rows=hv), P, interim=False)
    got = {(r.company, r.Z, r.metric): r["count"] for r in mart.filter(F.col("id") == 1).collect()}
    assert got[("HVFHV", "Citywide", "PickUps")] == 2            # UBER + LYFT
    assert got[("HV0009", "Citywide", "PickUps")] == 1           # unknown licence passes through
    assert got[("SHARED", "Core", "Trips")] == 1                 # shared ride counted as SHARED too
    assert got[("ALL", "Citywide", "PickUps")] == 3              # ALL excludes SHARED
    assert mart.filter(F.col("id") == 4).count() == 0            # id 4 has no zone name
    assert {r.Zone for r in mart.collect()} == {"Z1"}


def test_mart_cutoff_and_all_since(spark):
    rows = [{"datetimeid": 2000110500, "pulocationid": 1, "dolocationid": 1},   # last published month
            {"datetimeid": 2000120500, "pulocationid": 1, "dolocationid": 1},   # cutoff month: excluded
            {"datetimeid": 1998050500, "pulocationid": 1, "dolocationid": 1}]   # before ALL starts
    mart = TP.trips_mart(_mart_inputs(spark, yellow_rows=rows), P, interim=False)
    months = {(r.year_month, r.company) for r in mart.filter(F.col("metric") == "PickUps").collect()}
    assert (dt.date(2000, 11, 1), "YELLOW") in months
    assert (dt.date(2000, 11, 1), "ALL") in months
    assert (dt.date(1998, 5, 1), "YELLOW") in months
    assert (dt.date(1998, 5, 1), "ALL") not in months
    assert not any(m == dt.date(2000, 12, 1) for m, _ in months)


def test_fhv_counts_in_all_but_not_published(spark):
    fhv = [{"datetimeid": HK, "pulocationid": 2, "dolocationid": 2, "dispatching_base_num": "B1"}]
    mart = TP.trips_mart(_mart_inputs(spark, fhv_rows=fhv, bases_rows=[("B1", "BASE CO")]), P, interim=False)
    companies = {r.company for r in mart.collect()}
    assert companies == {"ALL"}


# -- A8-A12: fares NULL rules ----------------------------------------------------------

def test_fares_zero_drivers_and_null_measures(spark):
    ind = P.industry("yellow")
    t = trips(spark, "yellow", [
        {"datetimeid": HK, "pulocationid": 1, "dolocationid": 1, "hack_number": None, "extra": None,
         "tip_amount": Decimal("0.00"), "fare_amount": Decimal("8.00")},
        {"datetimeid": HK, "pulocationid": 1, "dolocationid": 1, "hack_number": None, "extra": Decimal("1.00"),
         "tip_amount": Decimal("2.00"), "fare_amount": None},
    ])
    r = monthly_fares(fare_trips(t, ind, ind.fares_start, 2000120100, P.fare_cap, P.distance_cap), ind).first()
    assert r.count_drivers == 0
    assert r.pay_per_driver is None and r.tips_per_driver is None
    assert r.avg_extra == 0.5          # yellow: avg(coalesce(extra, 0))
    assert r.avg_tip_amount == 2.0     # payers only: avg(nullif(tip, 0))
    assert r.avg_fare_amount == 8.0    # plain avg ignores NULL
    assert r.avg_airport_fee is None   # all NULL (no airport fee given)
    g = P.industry("green")
    tg = trips(spark, "green", [{"datetimeid": HK, "extra": None}, {"datetimeid": HK, "extra": Decimal("1.00")}])
    rg = monthly_fares(fare_trips(tg, g, g.fares_start, 2000120100, P.fare_cap, P.distance_cap), g).first()
    assert rg.avg_extra == 1.0         # green: avg(nullif(extra, 0))


def test_hv_avg_total_fare_is_null_when_a_part_is_all_null(spark):
    ind = P.industry("hvfhv")
    t = trips(spark, "hvfhv", [{"datetimeid": HK, "tolls": Decimal("1.00"), "driver_pay": Decimal("5.00")}])
    r = monthly_fares(fare_trips(t, ind, ind.fares_start, 2000120100, P.fare_cap, P.distance_cap), ind).first()
    assert r.avg_total_fare is None    # sum of averages: bcf etc. are NULL for the month
    assert r.sum_total_fare == 11.0    # sum of coalesced sums
    assert r.total_driver_pay == 5.0 and r.pay_per_driver == 5.0


# -- C5: zone financials keep ids without a name ------------------------------------------

def test_financials_keep_unnamed_ids(spark):
    y = [{"datetimeid": HK, "pulocationid": 4, "dolocationid": 1},
         {"datetimeid": HK, "pulocationid": None, "dolocationid": 1}]
    inp = _mart_inputs(spark, yellow_rows=y)
    fin = zone_financials_mart(inp, P)
    rows = fin.collect()
    assert {(r.id, r.Z, r.Zone) for r in rows} == {(4, "Citywide", None)}
    assert {r.metric for r in rows} == set(C.FINANCIAL_METRICS.values())
    assert len(rows) == 4
