"""Sorts (O1; O2 and O3 are the row order inside the mart's files, see the monthly run). Ordering is applied at the sink only: a global sort is a range
shuffle, and no operator in between depends on row order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_desc(df: DataFrame, *cols: str) -> DataFrame:
    """O1 / O2: newest month (and the other keys) first."""
    return df.orderBy(*[F.desc(c) for c in cols])

