"""Money in cents, mergeable driver counts, and fare tables from kept state that late files join."""

import datetime as dt
import random
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from farezone.config import fixture_params
from farezone.functions.money import cents_sum, money_avg, money_sum, total
from farezone.operators.drivers import count_drivers, driver_bitmaps, driver_places, merge_bitmaps
from farezone.plans.fare_state import add_trips, fares_kept
from farezone.plans.fares import fares_wide
from farezone.plans.inputs import TripInputs
from farezone.sources import published as P
from farezone.sources.readers import read_trips

from conftest import SF_SMALL


# -- money ---------------------------------------------------------------------------

def test_sums_of_money_are_exact(spark):
    r = random.Random(4)
    measures = [F.expr(f"{f('v')} AS {n}") for n, f in (("s", money_sum), ("c", cents_sum), ("t", total), ("a", money_avg))]
    for kind in ("decimal(12,2)", "decimal(4,2)", "decimal(8,2)", "decimal(18,2)"):
        whole = int(kind[8:-1].split(",")[0]) - 2
        values = [None, Decimal("0.00"), Decimal("0.01"), Decimal("-0.01"), Decimal("9.99"), Decimal("-99.99")]
        values += [Decimal(r.randrange(-10 ** (whole + 2) + 1, 10 ** (whole + 2))).scaleb(-2) for _ in range(300)]
        if whole > 6:
            values += [Decimal("999999.99"), Decimal("1000000.00"), Decimal("-1000000.00"), Decimal("1000000.01")]
        df = spark.createDataFrame([(i % 3, str(v) if v is not None else None) for i, v in enumerate(values)], "k int, v string")
        df = df.select("k", F.col("v").cast(kind).alias("v"))
        got = {x.k: x for x in df.groupBy("k").agg(*measures).collect()}
        for k in range(3):
            own = [v for i, v in enumerate(values) if i % 3 == k and v is not None]
            assert got[k].s == sum(own) == got[k].t and got[k].c == int(sum(own) * 100)
            assert got[k].a == float(sum(own)) / len(own)
    none = spark.createDataFrame([(None,)], "v decimal(12,2)").agg(*measures).first()
    assert (none.s, none.t, none.a) == (None, 0, None)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_sum_beyond_a_long_fails(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        most = spark.range(1001).select(F.lit(Decimal("9999999999999999.99")).cast("decimal(18,2)").alias("v"))
        with pytest.raises(Exception, match="beyond the range|overflow|OVERFLOW"):
            most.agg(F.expr(money_sum("v"))).collect()
        assert most.limit(9).agg(F.expr(money_sum("v")).alias("s")).first().s == 9 * Decimal("9999999999999999.99")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_fare_buffers_hold_no_wide_decimals(spark):
    inputs = TripInputs.from_fixtures(spark, SF_SMALL)
    plan = fares_wide(inputs, fixture_params(), "yellow")._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(UnscaledValue(" in plan and "sum(total_amount" not in plan


# -- drivers ---------------------------------------------------------------------------

@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_merged_driver_counts_equal_the_whole(spark, buckets):
    r = random.Random(buckets)
    trips = [(r.choice([200001, 200002, 200003]), r.choice([None, *[f"D{i}" for i in range(40)]])) for _ in range(400)]
    parts = [trips[:50], trips[50:60], trips[60:300], trips[300:]]
    places = bitmaps = None
    for part in parts:
        df = spark.createDataFrame(part, "year_month long, driver string")
        fresh = driver_places(df, places, buckets)
        places = fresh if places is None else places.unionByName(fresh)
        places = spark.createDataFrame(places.collect(), places.schema)
        one = driver_bitmaps(df.where("driver is not null"), places)
        bitmaps = one if bitmaps is None else merge_bitmaps(bitmaps, one)
        bitmaps = spark.createDataFrame(bitmaps.collect(), bitmaps.schema)
    kept = places.collect()
    assert len({x.place for x in kept}) == len({x.driver for x in kept}) == len(kept) == len({d for _, d in trips if d})
    assert min(x.place for x in kept) >= 1
    got = {x.year_month: x.drivers for x in count_drivers(bitmaps).collect()}
    assert got == {m: len({d for n, d in trips if n == m and d}) for m in (200001, 200002, 200003)}


def test_places_past_one_bitmap(spark):
    ids = spark.range(100_000).select(F.concat(F.lit("D"), "id").alias("driver"), F.lit(200001).cast("long").alias("year_month"))
    places = driver_places(ids, None, 3).cache()
    bitmaps = driver_bitmaps(ids, places)
    assert bitmaps.select("part").distinct().count() >= 4
    assert count_drivers(bitmaps).first().drivers == 100_000
    places.unpersist()


# -- state -----------------------------------------------------------------------------

@pytest.mark.parametrize("industry", ["yellow", "hvfhv", "shared"])
def test_late_files_join_their_months(spark, monkeypatch, industry):
    params, out = fixture_params(), tempfile.mkdtemp(prefix="state-")
    source = {"yellow": "yellow"}.get(industry, "hvfhv")
    inputs = TripInputs.from_fixtures(spark, SF_SMALL)
    trips = inputs.trips()[source]
    want = sorted(map(str, fares_wide(inputs, params, industry).collect()))
    root = tempfile.mkdtemp(prefix="late-")
    month = F.col("datetimeid").cast("string").substr(1, 6)
    parts = {"a": month < "200006", "b": (month >= "200006") & (F.col("pulocationid") % 2 == 0),
             "c": ~(month < "200006") & ~F.coalesce(F.col("pulocationid") % 2 == 0, F.lit(False))}
    for name, rows in parts.items():
        trips.where(rows).write.parquet(f"{root}/{name}")
    assert sum(spark.read.parquet(f"{root}/{n}").count() for n in parts) == trips.count()

    def add(name):
        add_trips(spark, out, read_trips(spark, f"{root}/{name}", source), params, industry)

    add("b")
    add("a")
    before = sorted(map(str, fares_kept(spark, out, params, industry).collect()))
    assert before != want
    untouched = {f for f in _files(f"{out}/_state/{industry}/sums") if "year_month=1999" in f}
    with monkeypatch.context() as m:  # the last table of the state can't be written
        plain = P.laid_out
        broken = F.raise_error(F.lit("no space left")).cast("double")
        m.setattr(P, "laid_out", lambda df, *how: plain(df, *how) if "variable" not in df.columns
                  else plain(df, *how).withColumn("value", broken))
        with pytest.raises(Exception, match="no space left"):
            add("c")
    assert sorted(map(str, fares_kept(spark, out, params, industry).collect())) == before
    add("c")
    assert sorted(map(str, fares_kept(spark, out, params, industry).collect())) == want
    assert untouched <= set(_files(f"{out}/_state/{industry}/sums"))
    with pytest.raises(ValueError, match="added before"):
        add("a")
    csv = P.read_published(spark, f"{out}/{industry}_fare").collect()
    assert [r.year_month for r in csv] == sorted((r.year_month for r in csv), reverse=True)
    assert max(r.year_month for r in csv) == str(dt.date(2000, 11, 1))


def _files(path):
    import os
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]
