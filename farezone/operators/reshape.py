"""Reshape (R1, R2) and set operations (U1). R3 lives in ``operators.zones``.

Wide -> long is an ``inline`` of one struct a measure: a Generate node in the same stage, no
shuffle. NULL measures are kept (like pandas ``melt``; SQL ``UNPIVOT`` needs
``INCLUDE NULLS``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from farezone.functions.text import literal, sql


def to_long(df: DataFrame, ids, values=None, variable: str = "variable", value: str = "value",
            rename: dict | None = None) -> DataFrame:
    """Wide -> long. ``values=None`` melts every non-id column.

    Values are cast to double first (mixed long/decimal/double columns), and
    ``rename`` maps column names to display names for the ``variable`` column.
    """
    ids = list(ids)
    values = [c for c in df.columns if c not in ids] if values is None else list(values)
    rename = rename or {}
    rows = ", ".join(f"struct({literal(rename.get(c, c))} AS {variable}, CAST(`{c}` AS double) AS {value})" for c in values)
    return sql(df, f"SELECT {', '.join(ids)}, inline(array({rows})) FROM {{df}}")


def stack(*dfs: DataFrame) -> DataFrame:
    """Union all by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
