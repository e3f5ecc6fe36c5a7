"""Queries as SQL text over DataFrames.

Wide projections and aggregations are written as one text: Spark parses it in one call, where the same
thing made of ``Column`` objects is a call to the JVM for each operator in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def sql(df: DataFrame, text: str, **frames: DataFrame) -> DataFrame:
    """``text`` with ``{df}`` and the names of ``frames`` standing for the DataFrames, all of one session."""
    return df.sparkSession.sql(text, df=df, **frames)


def literal(value) -> str:
    """A number or a string as SQL text, of the type that ``lit`` gives it."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)
