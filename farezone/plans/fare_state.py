"""Fare tables (A8-A12) from kept monthly state, for trip files that arrive late.

The state of an industry is, per month, the sums and counts that its fare measures are made of
(money in cents, longs) and the bitmaps of its drivers. Both merge: a late file's state is added to that of its
months, the other months aren't touched, and no trip counted before is read again. The fare
tables are projections of the state.

One scan of the trips gives everything: they are summed by month and driver into an interim
table, of which the months' sums and the driver bitmaps are aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farezone.config import Industry, Params
from farezone.functions.money import cents_sum, checked_sum, money_of, null_if_zero
from farezone.functions.text import sql
from farezone.functions.timekeys import MONTH_KEY, month_date, run_bounds
from farezone.operators.drivers import count_drivers, driver_bitmaps, driver_places, merge_bitmaps
from farezone.operators.fares import HV_MONEY, driver_column, fare_measures, fare_trips
from farezone.operators.ordering import sort_desc
from farezone.plans.fares import fares_long
from farezone.sources.published import Publication, current, read_published
from farezone.sources.sinks import interim_scope, write_interim

METERED_MONEY = ("total_amount", "fare_amount", "extra", "tip_amount", "tolls_amount", "mta_tax",
                 "improvement_surcharge", "congestion_surcharge")


def money_columns(industry: Industry) -> tuple:
    if industry.name in ("yellow", "green"):
        return METERED_MONEY + (("airport_fee",) if industry.name == "yellow" else ())
    return HV_MONEY


class StateTerms:
    """What fare measures are made of, as columns of a month's state."""

    def money(self, c: str) -> str:
        return money_of(f"cents_{c}")

    def number(self, c: str) -> str:
        return f"sum_{c}"

    def count(self, c: str) -> str:
        return f"n_{c}"

    def payers(self, c: str) -> str:
        return f"paid_{c}"

    def rows(self) -> str:
        return "trips"

    def drivers(self) -> str:
        return "drivers"


def driver_months(trips: DataFrame, industry: Industry) -> DataFrame:
    """The sums of ``trips`` by month key and driver (NULL: trips without one)."""
    distance, driver = industry.distance, driver_column(industry)
    terms = ["count(1) AS trips", f"sum({distance}) AS sum_{distance}", f"count({distance}) AS n_{distance}"]
    for c in money_columns(industry):
        terms += [f"{cents_sum(c)} AS cents_{c}", f"count({c}) AS n_{c}", f"count({null_if_zero(c)}) AS paid_{c}"]
    return sql(trips, f"""
        SELECT {MONTH_KEY} AS year_month, {driver} AS driver, {", ".join(terms)} FROM {{df}} GROUP BY {MONTH_KEY}, {driver}""")


def merge_sums(parts: DataFrame) -> DataFrame:
    """One row for each month, whatever number of parts it comes in."""
    whole = [c for c in parts.columns if c not in ("year_month", "driver")]
    sums = ", ".join(f"{checked_sum(c) if c.startswith('cents_') else f'sum({c})'} AS {c}" for c in whole)
    return sql(parts, f"SELECT year_month, {sums} FROM {{df}} GROUP BY year_month")


def fares_of_state(sums: DataFrame, bitmaps: DataFrame, industry: Industry) -> DataFrame:
    """A8-A11 from the state: the columns of ``fares_wide``, ``year_month`` as a date."""
    d = sums.join(count_drivers(bitmaps), "year_month", "left").withColumn("drivers", F.coalesce("drivers", F.lit(0).cast("long")))
    measures = ", ".join(f"{x} AS {n}" for n, x in fare_measures(industry, StateTerms()))
    return sql(d, f"SELECT year_month, {measures} FROM {{df}}").withColumn("year_month", month_date("year_month"))


def _tables(industry: str) -> tuple:
    return tuple(f"_state/{industry}/{t}" for t in ("sums", "bitmaps", "places", "files"))


def _kept(spark: SparkSession, root: str, name: str, like: DataFrame) -> DataFrame:
    """A table of the state as published; empty before the first."""
    df = read_published(spark, f"{root}/{name}", like.schema)
    return like.limit(0) if df is None else df.select(*like.columns)


def add_trips(spark: SparkSession, out_dir: str, trips: DataFrame, params: Params, industry: str, files: list | None = None) -> None:
    """Add ``trips`` of one industry to its state under ``out_dir`` and republish its fare tables
    (``{industry}_fare`` and ``{industry}_fare_melt``), all in one step.

    ``trips`` may belong to any months, published before or not. Its files (``files``, by default those
    that Spark reads for it) are noted, and one that was added before is refused, so nothing counts twice;
    a failed call leaves state and tables as they were and can be repeated."""
    ind = params.industry(industry)
    _, end = run_bounds(params.asof)
    sums_at, bitmaps_at, places_at, files_at = _tables(industry)
    files = sorted(set(trips.inputFiles() if files is None else files))
    ledger = spark.createDataFrame([(f,) for f in files], "file string")
    known_files = _kept(spark, out_dir, files_at, ledger)
    again = [r.file for r in ledger.join(known_files, "file", "left_semi").limit(3).collect()]
    if again:
        raise ValueError(f"{industry}: files were added before: {', '.join(again)}, ...")
    with interim_scope(spark), Publication(spark, out_dir) as publication:
        chosen = fare_trips(trips, ind, ind.fares_start, end, params.fare_cap, params.distance_cap)
        by_driver = write_interim(driver_months(chosen, ind), f"driver-months-{industry}")
        new_sums = merge_sums(by_driver)
        known = _kept(spark, out_dir, places_at, spark.createDataFrame([], "driver string, place long"))
        fresh = write_interim(driver_places(by_driver, known), f"places-{industry}")
        new_bitmaps = driver_bitmaps(by_driver.where(F.col("driver").isNotNull()), known.unionByName(fresh))
        months = by_driver.select("year_month").distinct()
        old_sums = _kept(spark, out_dir, sums_at, new_sums).join(months, "year_month", "left_semi")
        old_bitmaps = _kept(spark, out_dir, bitmaps_at, new_bitmaps).join(months, "year_month", "left_semi")
        every = lambda values: True  # noqa: E731  months without new trips stay where they are
        publication.write(sums_at, merge_sums(old_sums.unionByName(new_sums)), "year_month", keep=every)
        publication.write(bitmaps_at, merge_bitmaps(old_bitmaps, new_bitmaps), "year_month", keep=every)
        publication.write(places_at, fresh.withColumn("added", F.lit(publication.version)), "added", keep=every)
        publication.write(files_at, ledger.withColumn("added", F.lit(publication.version)), "added", keep=every)
        wide = fares_of_state(publication.read(sums_at, new_sums.schema), publication.read(bitmaps_at, new_bitmaps.schema), ind)
        publication.write(f"{industry}_fare", sort_desc(wide, "year_month"), fmt="csv")
        publication.write(f"{industry}_fare_melt", sort_desc(fares_long(wide), "year_month"), fmt="csv")


def fares_kept(spark: SparkSession, out_dir: str, params: Params, industry: str) -> DataFrame:
    """The fare table of the state published under ``out_dir``, with its own types."""
    if current(spark, out_dir) is None:
        raise ValueError(f"nothing is published under {out_dir}")
    sums_at, bitmaps_at, _, _ = _tables(industry)
    sums = read_published(spark, f"{out_dir}/{sums_at}")
    bitmaps = read_published(spark, f"{out_dir}/{bitmaps_at}")
    return fares_of_state(sums.withColumn("year_month", F.col("year_month").cast("long")),
                          bitmaps.withColumn("year_month", F.col("year_month").cast("long")), params.industry(industry))
