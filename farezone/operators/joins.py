"""Joins (J1, J3, J5, J6).

Which side is broadcast is Spark's own choice, by bytes: ``autoBroadcastJoinThreshold`` when the
plan is made and AQE's threshold once a side's size is known. Zone dimensions (membership,
names: a row for each taxi zone and service zone) and the base list are far below it in
practice, so trips aren't shuffled to meet them; a larger side becomes a shuffle join that AQE
splits where a key is hot. No job runs while a plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trips_with_base(trips: DataFrame, bases: DataFrame) -> DataFrame:
    """Inner join ``dispatching_base_num = lic_no`` attaching the company.

    Duplicate ``lic_no`` rows multiply trips, as a plain SQL join does
    (see :func:`duplicate_keys`).
    """
    b = bases.select("lic_no", "company")
    return trips.join(b, trips["dispatching_base_num"] == b["lic_no"], "inner").drop("lic_no")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once (a data check for J1's base list)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def with_zone_name(df: DataFrame, names: DataFrame, key: str = "id") -> DataFrame:
    """Left join of the id to its zone name; an unknown id gets NULL."""
    n = names.withColumnRenamed("id", key)
    return df.join(n, key, "left")


def in_zone(df: DataFrame, members: DataFrame, key: str = "id") -> DataFrame:
    """J5 / F7 for one zone: keep rows whose ``key`` is a member (semi join).

    Semi and anti joins never duplicate left rows, so the membership side needs
    no ``distinct`` (which would add a shuffle under the broadcast)."""
    m = members.select(F.col("id").alias(key))
    return df.join(m, key, "left_semi")


def not_in_zone(df: DataFrame, members: DataFrame, key: str = "id") -> DataFrame:
    """Keep rows whose ``key`` is not a member; a NULL key counts as outside."""
    m = members.select(F.col("id").alias(key))
    return df.join(m, key, "left_anti")
