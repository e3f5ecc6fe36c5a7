"""The inputs of a run: trip tables and dimensions, from production paths or fixtures."""

from __future__ import annotations

import os
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farezone.sources import fixtures, readers
from farezone.sources.sinks import shared_dir, write_interim

_MATERIALIZED: dict = {}
_LOCK = threading.Lock()


def materialized_trip_views(spark: SparkSession, sf_dir: str) -> dict:
    """The four derived trip views written once per session as Parquet tables in
    the shared checkpoint folder, then read like production trip files (with a
    real ``datetimeid`` column for F1 pushdown and row-group skipping)."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    with _LOCK:
        if key not in _MATERIALIZED:
            root = f"{shared_dir(spark)}/fixtures/{uuid.uuid4().hex}"
            views = {}
            # the join behind all views runs once; each view is a projection of its part
            fixtures.joined_base(spark, sf_dir).write.partitionBy("view").parquet(f"{root}/_base")
            base = spark.read.parquet(f"{root}/_base")
            # time-ordered files, like a folder of monthly trip files: scans run in
            # parallel and hour-key filters skip whole files by their min/max
            n = spark.sparkContext.defaultParallelism
            for name, (_, columns) in fixtures.VIEW_RULES.items():
                path = f"{root}/{name}"
                (base.filter(F.col("view") == name).selectExpr(*columns).repartitionByRange(n, "datetimeid")
                 .sortWithinPartitions("datetimeid").write.mode("overwrite").parquet(path))
                views[name] = readers.read_trips(spark, path, name)
            _MATERIALIZED[key] = views
    return _MATERIALIZED[key]


def joined_trip_views(spark: SparkSession, sf_dir: str) -> dict:
    """The four derived trip views over their join, which is written once as an interim table: for
    jobs of several plans over the trips. Each view reads its own folder of it."""
    base = write_interim(fixtures.joined_base(spark, sf_dir).drop("o_orderpriority"), "joined_trips", partition_by=("view",))
    return {name: base.filter(F.col("view") == name).selectExpr(*columns) for name, (_, columns) in fixtures.VIEW_RULES.items()}


class TripInputs:
    """Trip tables and dimensions of a run.

    Each input is a DataFrame or a zero-argument builder; builders run on first
    access, so a query opens only the tables it uses.
    """

    FIELDS = ("yellow", "green", "fhv", "hvfhv", "bases", "zone_matrix", "zone_lookup", "daily")

    def __init__(self, **sources):
        unknown = set(sources) - set(self.FIELDS)
        if unknown:
            raise TypeError(f"unknown inputs: {sorted(unknown)}")
        self._sources = sources
        self._built: dict = {}

    def __getattr__(self, name: str):
        if name not in TripInputs.FIELDS:
            raise AttributeError(name)
        if name not in self._built:
            src = self._sources.get(name)
            self._built[name] = src() if callable(src) else src
        return self._built[name]

    def trips(self) -> dict:
        return {"yellow": self.yellow, "green": self.green, "fhv": self.fhv, "hvfhv": self.hvfhv}

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str, materialize: bool = True) -> "TripInputs":
        """Inputs derived from the tables in ``sf_dir``. With ``materialize`` the
        trip views are written once per session (see :func:`materialized_trip_views`),
        like production's trip files (for tests of scans and for runs on files); otherwise,
        as in every registered query, they stay lazy joins over the base tables."""
        tables = fixtures.Tables(spark, sf_dir)

        def trip(name):
            if materialize:
                return lambda: materialized_trip_views(spark, sf_dir)[name]
            return lambda: fixtures.trip_view(name, tables)

        return cls(
            yellow=trip("yellow"),
            green=trip("green"),
            fhv=trip("fhv"),
            hvfhv=trip("hvfhv"),
            bases=lambda: fixtures.bases(spark, sf_dir, tables),
            zone_matrix=lambda: fixtures.zone_matrix(spark, sf_dir, tables),
            zone_lookup=lambda: fixtures.zone_lookup(spark, sf_dir, tables),
            daily=lambda: fixtures.daily_indicators(spark, sf_dir, tables),
        )

    def with_trips(self, trips: dict) -> "TripInputs":
        """The same inputs with other trip tables."""
        return TripInputs(**{**self._sources, **trips})

    @classmethod
    def from_paths(cls, spark: SparkSession, trips: dict, bases: str, zone_matrix: str,
                   zone_lookup: str, daily: DataFrame | None = None) -> "TripInputs":
        """``trips`` maps ``yellow``, ``green``, ``fhv``, ``hvfhv`` to Parquet globs."""
        return cls(
            yellow=readers.read_trips(spark, trips["yellow"], "yellow"),
            green=readers.read_trips(spark, trips["green"], "green"),
            fhv=readers.read_trips(spark, trips["fhv"], "fhv"),
            hvfhv=readers.read_trips(spark, trips["hvfhv"], "hvfhv"),
            bases=readers.read_bases(spark, bases),
            zone_matrix=readers.read_zone_matrix(spark, zone_matrix),
            zone_lookup=readers.read_zone_names(spark, zone_lookup),
            daily=daily,
        )
