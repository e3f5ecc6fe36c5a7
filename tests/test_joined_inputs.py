"""The trip views of jobs with several plans: their join is made and written once."""

from farezone.plans import catalog
from farezone.plans.inputs import TripInputs, joined_trip_views
from farezone.sources import fixtures
from tests.conftest import SF_SMALL


def test_extend_mart_joins_the_trips_once(spark, monkeypatch):
    joins = []
    real = fixtures._over_base
    monkeypatch.setattr(fixtures, "_over_base", lambda *a: joins.append(a) or real(*a))
    assert catalog.extend_mart_q(spark, SF_SMALL).count() > 0
    assert len(joins) == 1


def test_joined_views_are_the_lazy_views(spark):
    lazy = TripInputs.from_fixtures(spark, SF_SMALL, materialize=False).trips()
    for name, view in joined_trip_views(spark, SF_SMALL).items():
        assert view.dtypes == lazy[name].dtypes
        assert view.exceptAll(lazy[name]).isEmpty() and lazy[name].exceptAll(view).isEmpty()
        plan = view._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "PartitionFilters: [isnotnull(view" in plan


def test_orders_meet_customers_before_lineitems(spark):
    plan = fixtures.yellow(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    at = lambda key: next(i for i, line in enumerate(joins) if key in line)
    assert at("o_custkey") > at("l_orderkey")   # deeper in the plan
