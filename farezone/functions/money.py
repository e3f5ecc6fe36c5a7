"""Money and ratio helpers (P6-P8, P17, P18), as SQL text.

A fare table has some forty measures. As text, a measure is one expression for Spark to parse; built from
``Column`` objects it would be a call to the JVM for every operator and operand in it, which costs more
than a small month's scan.

Money has at most two decimals. It is summed exactly, as whole cents in a long, and becomes a
decimal again once a group's sum is complete; averages and ratios are formed as ``double(sum) /
count`` at the end, so every engine produces the same double.
"""

from __future__ import annotations


def zero_if_null(x: str) -> str:
    """``COALESCE(x, 0)``."""
    return f"coalesce({x}, 0)"


def null_if_zero(x: str) -> str:
    """``NULLIF(x, 0)`` -- averages over payers only."""
    return f"nullif({x}, 0)"


def rider_total(parts) -> str:
    """Row-wise sum of the rider's fare parts, each NULL counted as 0."""
    return "(" + " + ".join(zero_if_null(p) for p in parts) + ")"


def ratio(num: str, den: str) -> str:
    """``num / den`` in double; NULL when the denominator is 0 or NULL."""
    return f"(CAST({num} AS double) / CAST(nullif({den}, 0) AS double))"


def exact_avg(x: str) -> str:
    """``avg(x)`` as double(sum) / count: exact sum, one final division."""
    return ratio(f"sum({x})", f"count({x})")


def cents_sum(x: str) -> str:
    """Sum of money in cents, a long (NULL without values). A sum that no long holds fails, in
    any ANSI mode; it is never NULL or wrapped.

    Amounts below a million are summed as ``decimal(8,2)``, which Spark adds up as plain longs (a sum of
    type ``decimal(18,2)``: 10 billion of the greatest of them); the rest, rare in fares, is turned to
    cents one by one. Neither needs the wide decimals that a plain sum of ``decimal(12,2)``
    keeps in each of its buffers."""
    small = f"try_cast({x} AS decimal(8,2))"
    low = f"sum(coalesce({small}, CAST(0 AS decimal(8,2))))"
    high = f"try_sum(coalesce(CASE WHEN {small} IS NULL THEN CAST({x} * 100 AS bigint) END, 0L))"
    failed = "raise_error('a sum of money is beyond the range of a long in cents')"
    return f"(CASE WHEN count({x}) > 0 THEN coalesce(try_add(CAST({low} * 100 AS bigint), {high}), {failed}) END)"


def checked_sum(x: str) -> str:
    """Sum of longs (NULL without values) that fails where no long holds it."""
    return f"(CASE WHEN count({x}) > 0 THEN coalesce(try_sum({x}), raise_error('the sum of {x} is beyond the range of a long')) END)"


def money_of(cents: str) -> str:
    """Cents (long) as a decimal amount."""
    return f"(CAST({cents} AS decimal(19,0)) * 0.01BD)"


def money_sum(x: str) -> str:
    """Exact sum of money, NULL without values."""
    return money_of(cents_sum(x))


def money_avg(x: str) -> str:
    """Average of money over the rows that have a value."""
    return ratio(money_sum(x), f"count({x})")


def total(x: str) -> str:
    """Sum of money with NULL as 0 (P6): the plain sum's buffer, 0 where no value is there."""
    return zero_if_null(money_sum(x))


def to_minutes(avg_seconds: str) -> str:
    """Average seconds -> minutes."""
    return f"({avg_seconds} / 60.0D)"
