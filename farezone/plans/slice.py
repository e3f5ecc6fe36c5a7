"""The dashboard's question over the published mart -- one metric by
location, industry and period. Against a mart written with
``partitionBy("metric")`` the metric filter prunes directories and the rest
are pushed into the Parquet scan."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mart_slice(mart: DataFrame, metric: str, zones=None, companies=None,
               start: _dt.date | None = None, end: _dt.date | None = None) -> DataFrame:
    d = mart.filter(F.col("metric") == metric)
    if zones:
        d = d.filter(F.col("Z").isin(*zones))
    if companies:
        d = d.filter(F.col("company").isin(*companies))
    if start is not None:
        d = d.filter(F.col("year_month") >= F.lit(start))
    if end is not None:
        d = d.filter(F.col("year_month") < F.lit(end))
    return d
