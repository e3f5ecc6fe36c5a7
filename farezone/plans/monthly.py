"""The monthly run: every published table of the reference job.

``run_monthly`` builds the outputs and writes them through the sinks:

* ``trips_updated/`` -- the trips mart plus the zone financials, one mart (Parquet
  or CSV) partitioned by ``metric`` and ``year_month``, each file sorted by its keys
  (O3), financials by month, company and zone descending (O2);
* ``{industry}_fare/`` and ``{industry}_fare_melt/`` -- wide and long fare
  tables as CSV, newest month first (S8, O1), exported from a small Parquet
  store partitioned by month (``_store/``);
* ``fhv3/`` -- traditional FHV monthly totals as CSV, newest month first.

Each is a table of one publication (:mod:`farezone.sources.published`): files lie in
``version=…`` folders, and a manifest in the output folder switches all tables in one step.

Every published number is per month, so ``since`` turns the run incremental:
the trip scans read only months from ``since`` on (pushed-down hour-key bound), and the
published months before it are kept (S10). Either way the months published are
exactly the run's: none that an earlier run had, and this one hasn't, stays.

Nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from farezone import config as C
from farezone.config import Params, since as since_params
from farezone.operators.checks import Checks
from farezone.operators.ordering import sort_desc
from farezone.plans.fares import fares_long, fares_wide
from farezone.plans.fhv import traditional_fhv_totals
from farezone.plans.financials import zone_financials_mart
from farezone.plans.inputs import TripInputs
from farezone.plans.trips import trips_mart
from farezone.sources.readers import read_mart
from farezone.sources.published import Publication
from farezone.sources.sinks import existing, interim_scope, stage

FARE_INDUSTRIES = ("yellow", "green", "hvfhv")


def run_monthly(inputs: TripInputs, params: Params, out_dir: str, fmt: str = "parquet",
                since: _dt.date | None = None, checks: Checks | None = None, spread: int | None = None) -> dict:
    """Write every output under ``out_dir``; returns the paths written (read them with
    ``read_mart`` or ``read_published``).

    With ``since``, only months from ``since`` on are recomputed and replaced. All tables change
    together, once the last of them is written; if the run fails before, they are as they
    were. Interim tables are deleted when everything is written. ``checks`` takes what the run has
    seen (rows, NULL ids, dropped trips, companies), observed in the job that reads the trips. ``spread``
    writes the mart in so many tasks, in ranges of its order, for partitions too large for one.
    """
    spark = inputs.yellow.sparkSession
    with interim_scope(spark), Publication(spark, out_dir) as publication:
        return _write_all(inputs, params, publication, fmt, since, checks, spread)


def _write_all(inputs: TripInputs, params: Params, publication: Publication, fmt: str, since: _dt.date | None,
               checks: Checks | None, spread: int | None) -> dict:
    p = params if since is None else since_params(params, since)
    spark, out_dir = inputs.yellow.sparkSession, publication.root
    since_month = None if since is None else since.replace(day=1)

    def unversioned(name, read):
        """What an incremental run must not lose: a table that was published without versions."""
        return None if since is None or publication.published(name) else existing(read)

    mart = trips_mart(inputs, p, checks=checks).withColumn("count", F.col("count").cast("double"))
    financials = zone_financials_mart(inputs, p)
    # O3 for trip metrics (ascending keys); O2 for financials (company, then zone, descending)
    trip_metric = F.col("metric").isin(C.METRIC_TRIPS, C.METRIC_PICKUPS, C.METRIC_DROPOFFS)
    order = [F.when(trip_metric, F.col(c)) for c in ("id", "company", "Z")] + [F.desc("company"), F.desc("Z"), "id"]
    stage(publication, "trips_updated", mart.unionByName(financials.select(*mart.columns)), ("metric", "year_month"), fmt,
          order, since_month, unversioned("trips_updated", lambda: read_mart(spark, f"{out_dir}/trips_updated", fmt)), spread=spread)
    names = ["trips_updated"]
    for ind in FARE_INDUSTRIES:
        wide = fares_wide(inputs, p, ind)
        store = f"_store/{ind}_fare"
        stage(publication, store, wide, "year_month", since=since_month,
              published=unversioned(store, lambda: spark.read.parquet(f"{out_dir}/{store}").select(*wide.columns)))
        months = publication.read(store, wide.schema).select(*wide.columns)
        publication.write(f"{ind}_fare", sort_desc(months, "year_month"), fmt="csv")
        publication.write(f"{ind}_fare_melt", sort_desc(fares_long(months), "year_month"), fmt="csv")
        names += [f"{ind}_fare", f"{ind}_fare_melt"]
    if inputs.daily is not None:
        publication.write("fhv3", sort_desc(traditional_fhv_totals(inputs.daily, p), "year_month"), fmt="csv")
        names.append("fhv3")
    return {name: f"{out_dir}/{name}" for name in names}
