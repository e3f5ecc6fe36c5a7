"""Property test of the core semantic (J2, A6, A5 by zone) on random OD tables
against a plain-Python statement of the rules:

* volume per (month, id, company, zone) = pickups at id inside the zone
  + drop-offs at id from pickups outside the zone (NULL pickup = outside);
* a key exists only where there is a pickup at that id in that month.
"""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from farezone.operators.zones import inbound, zone_metrics, zone_volume

OD_SCHEMA = T.StructType([
    T.StructField("year_month", T.LongType()), T.StructField("pulocationid", T.IntegerType()),
    T.StructField("dolocationid", T.IntegerType()), T.StructField("company", T.StringType()),
    T.StructField("count", T.LongType())])

ids = st.one_of(st.none(), st.integers(1, 5))
od_rows = st.lists(st.tuples(st.sampled_from([200001, 200002]), ids, ids,
                             st.sampled_from(["a", "b"]), st.integers(1, 9)), min_size=1, max_size=25)
zones = st.dictionaries(st.sampled_from(["Z1", "Z2", "Z3"]),
                        st.sets(st.integers(1, 5), min_size=1, max_size=4), min_size=1, max_size=3)


def expected(rows, zone_ids):
    pick, inb, drop = defaultdict(int), defaultdict(int), defaultdict(int)
    for ym, pu, do, comp, n in rows:
        for z, members in zone_ids.items():
            if pu is not None and pu in members:
                pick[(ym, pu, comp, z)] += n
            if do is not None and do in members:
                drop[(ym, do, comp, z)] += n
                if pu is None or pu not in members:
                    inb[(ym, do, comp, z)] += n
    vol = {k: (c, inb.get(k, 0), c + inb.get(k, 0)) for k, c in pick.items()}
    return vol, dict(inb), dict(pick), dict(drop)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=od_rows, zone_ids=zones)
def test_zone_semantics_match_rules(spark, rows, zone_ids):
    od = spark.createDataFrame(rows, OD_SCHEMA)
    names = sorted(zone_ids)
    matrix = spark.createDataFrame([(i, *["Yes" if i in zone_ids[z] else "No" for z in names]) for i in range(1, 6)],
                                   "ID int, " + ", ".join(f"{z} string" for z in names))
    vol, inb, pick, drop = expected(rows, zone_ids)
    got_vol = {(r.year_month, r.id, r.company, r.zone): (r["count"], r.count1, r.volume)
               for r in zone_volume(od, matrix).collect()}
    assert got_vol == vol
    got_inb = {(r.year_month, r.id, r.company, r.zone): r.count1 for r in inbound(od, matrix).collect()}
    assert got_inb == inb
    zm = zone_metrics(od, matrix).collect()
    assert {(r.year_month, r.id, r.company, r.zone): r.pickups for r in zm if r.pickups is not None} == pick
    assert {(r.year_month, r.id, r.company, r.zone): r.dropoffs for r in zm if r.dropoffs is not None} == drop
