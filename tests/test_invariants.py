"""Independent check of J2 and the invariants of SURVEY 5 on the sf0.001 fixtures."""

import random

import pandas as pd
import pytest

from farezone import config as C
from farezone.config import fixture_params
from farezone.operators.aggregates import industry_od
from farezone.operators.zones import zone_metrics, zone_volume
from farezone.plans import trips as TP
from farezone.plans.fares import fares_long, fares_wide
from farezone.plans.inputs import TripInputs

from conftest import SF_SMALL

P = fixture_params()


@pytest.fixture(scope="module")
def inputs(spark):
    return TripInputs.from_fixtures(spark, SF_SMALL)


@pytest.fixture(scope="module")
def od_pd(spark, inputs):
    return industry_od(inputs.trips(), inputs.bases, P).toPandas()


def test_zone_volume_equals_per_zone_loop(spark, inputs, od_pd):
    """J2 against a per-zone pandas loop over the (small) OD table: for each zone,
    pickups inside, left-joined to drop-offs inside whose pickup is outside."""
    matrix = inputs.zone_matrix.toPandas()
    zones = [c for c in matrix.columns if c not in ("ID", C.CITYWIDE)]
    od = od_pd
    out = []
    for z in zones:
        ids = set(matrix.loc[matrix[z] == "Yes", "ID"])
        pu = (od[od.pulocationid.notna() & od.pulocationid.isin(ids)]
              .groupby(["year_month", "pulocationid", "company"], as_index=False)["count"].sum()
              .rename(columns={"pulocationid": "id"}))
        outside = ~od.pulocationid.isin(ids) | od.pulocationid.isna()
        f = (od[outside & od.dolocationid.isin(ids)]
             .groupby(["year_month", "dolocationid", "company"], as_index=False)["count"].sum()
             .rename(columns={"dolocationid": "id", "count": "count1"}))
        e = pu.merge(f, on=["year_month", "id", "company"], how="left").fillna({"count1": 0})
        e["zone"] = z
        out.append(e)
    loop = pd.concat(out)
    expect = {(int(r.year_month), int(r.id), r.company, r.zone, int(r["count"]), int(r.count1))
              for _, r in loop.iterrows()}
    od_df = spark.createDataFrame(od_pd)
    got = {(r.year_month, r.id, r.company, r.zone, r["count"], r.count1)
           for r in zone_volume(od_df, inputs.zone_matrix, exclude=(C.CITYWIDE,)).collect()}
    assert len(expect) > 100
    assert got == expect


@pytest.fixture(scope="module")
def mart(spark, inputs):
    return TP.trips_mart(inputs, P).toPandas()


def test_volume_at_least_pickups(mart):
    key = ["year_month", "id", "company", "Z"]
    t = mart[(mart.metric == "Trips") & (mart.Z != C.CITYWIDE)].set_index(key)["count"]
    p = mart[mart.metric == "PickUps"].set_index(key)["count"]
    j = t.to_frame("t").join(p.to_frame("p"), how="inner")
    assert len(j) > 0 and (j.t >= j.p).all()


def test_all_at_least_visible_companies(mart):
    since = pd.Timestamp(P.all_since).date()
    m = mart[mart.year_month >= since]
    key = ["year_month", "id", "Z", "metric"]
    visible = m[~m.company.isin(["ALL", "SHARED"])].groupby(key)["count"].sum()
    alls = m[m.company == "ALL"].set_index(key)["count"]
    j = visible.to_frame("v").join(alls.to_frame("a"), how="left")
    assert j.a.notna().all() and (j.a >= j.v).all()


def test_core_plus_non_core_plus_rest_is_citywide(mart):
    """Core and Non_Core are disjoint; with the ids in neither they make up Citywide."""
    p = mart[(mart.metric == "PickUps")]
    key = ["year_month", "company"]
    city = p[p.Z == C.CITYWIDE].groupby(key)["count"].sum()
    core = p[p.Z == "Core"].groupby(key)["count"].sum()
    non = p[p.Z == "Non_Core"].groupby(key)["count"].sum()
    neither_ids = set(p[p.Z == C.CITYWIDE].id) - set(p[p.Z.isin(["Core", "Non_Core"])].id)
    rest = p[(p.Z == C.CITYWIDE) & p.id.isin(neither_ids)].groupby(key)["count"].sum()
    total = core.add(non, fill_value=0).add(rest, fill_value=0)
    assert (total.reindex(city.index).fillna(0) == city).all()


def test_to_long_rows_are_rows_times_measures(spark, inputs):
    w = fares_wide(inputs, P, "yellow")
    n_rows, n_measures = w.count(), len(w.columns) - 1
    assert n_measures == 26
    assert fares_long(w).count() == n_rows * n_measures
    assert len(fares_wide(inputs, P, "green").columns) - 1 == 24
    assert len(fares_wide(inputs, P, "hvfhv").columns) - 1 == 24


def test_mart_has_no_null_keys_and_no_fhv(mart):
    assert not mart[["year_month", "id", "company", "Z", "Zone", "metric"]].isna().any().any()
    assert "FHV" not in set(mart.company)
    assert {"YELLOW", "GREEN", "HVFHV", "SHARED", "ALL"} <= set(mart.company)


@pytest.mark.parametrize("n_zones", [0, 5, 62, 70, 130])
def test_masks_of_any_number_of_zones(spark, n_zones):
    """Membership masks against sets, also past one mask column; ids may stand on several lines."""
    r = random.Random(n_zones)
    names = [f"Z{i}" for i in range(n_zones)]
    lines = [(i, *[r.choice(["Yes", "No", None]) for _ in names]) for i in [1, 2, 3, 4, 5, 2, 5]]
    matrix = spark.createDataFrame(lines, "ID int" + "".join(f", {z} string" for z in names))
    member = {z: {row[0] for row in lines if row[k + 1] == "Yes"} for k, z in enumerate(names)}
    od = [(200001, r.choice([1, 2, 3, 4, 5, 6, None]), r.choice([1, 2, 3, 4, 5, 6, None]), "X", r.randrange(1, 9)) for _ in range(60)]
    want = {}
    for month, pu, do, company, n in od:
        for z, ids in member.items():
            for side, i in (("pickups", pu), ("dropoffs", do), ("inbound", do)):
                if i in ids and (side != "inbound" or pu not in ids):
                    key = (month, i, company, z)
                    want.setdefault(key, {}).setdefault(side, 0)
                    want[key][side] += n
    got = zone_metrics(spark.createDataFrame(od, "year_month long, pulocationid int, dolocationid int, company string, count long"), matrix)
    assert {(x.year_month, x.id, x.company, x.zone): {s: x[s] for s in ("pickups", "dropoffs", "inbound") if x[s] is not None}
            for x in got.collect()} == want


def test_zone_counts_take_one_look_up_an_end(spark, inputs):
    """No join on (zone, pickup) and no row for a zone before the sums."""
    df = zone_volume(industry_od(inputs.trips(), inputs.bases, P), inputs.zone_matrix, exclude=(C.CITYWIDE,))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    above_od = plan[:plan.index("sum(count")]
    joins = [line for line in above_od.splitlines() if " Join " in line or line.lstrip(":+- ").startswith("Join")]
    assert len(joins) == 2 and all("LeftOuter" in j for j in joins)
    assert not any("zone#" in j for j in joins)
