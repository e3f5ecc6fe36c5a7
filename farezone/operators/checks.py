"""Checks of a run as observed metrics (A17 and the reference's printed counts): they come with the job
that reads the trips anyway, nothing is read or computed twice for them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from farezone.config import Industry


class Checks:
    """What a run has seen, by table: filled when the observed tables have been written.

    Of each trip table, within the period read (F1): ``trips``, those without a pickup or a drop-off, those
    that F2 drops (measures not positive), and shared rides (hv); of the counts by pair of zones the trips counted
    and the companies seen (A17).
    """

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def watch(self, name: str, df: DataFrame, metrics: dict) -> DataFrame:
        """``df``, observed by SQL aggregates ``metrics`` under ``name``."""
        self._seen[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        return df.observe(self._seen[name], *[F.expr(f"{x} AS {n}") for n, x in metrics.items()])

    def trips(self, name: str, df: DataFrame, industry: Industry) -> DataFrame:
        """A trip table after F1, whose filter still reaches the files."""
        metrics = {"trips": "count(1)", "no_pickup": "count_if(pulocationid IS NULL)", "no_dropoff": "count_if(dolocationid IS NULL)"}
        if industry.has_measures:
            metrics["dropped"] = f"count_if(NOT coalesce({industry.distance} > 0 AND {industry.fare} > 0, false))"
        if industry.company_col is not None:
            metrics["shared"] = "count_if(route_id IS NOT NULL)"
        return self.watch(name, df, metrics)

    def counts(self, od: DataFrame) -> DataFrame:
        return self.watch("od", od, {"rows": "count(1)", "trips": "sum(count)", "companies": "sort_array(collect_set(company))"})

    def seen(self) -> dict:
        """Every metric; waits for the tables that are being written."""
        return {name: dict(o.get) for name, o in self._seen.items()}
