"""Additive measures and the ratios made from them.

Every feature set is "group, add up, divide". The added-up part is kept apart from the dividing
part, so one pass over the transactions at a fine grain serves all coarser feature sets: measures
of small groups merge exactly (counts, decimal sums, minima, maxima) into measures of big ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendgrain.functions.literals import sql_text
from spendgrain.schema import MONEY_SQUARES, MONEY_SUM

_MONEY_SUM, _SQUARES = MONEY_SUM.simpleString(), MONEY_SQUARES.simpleString()

# Name -> (how it is taken from transactions, how partial values are merged).
MEASURES = {
    "row_count": ("count(1)", "sum(row_count)"),
    "id_count": ("count(transaction_id)", "sum(id_count)"),
    "amount_count": ("count(amount_spent)", "sum(amount_count)"),
    "amount_sum": (f"CAST(sum(amount_spent) AS {_MONEY_SUM})", f"CAST(sum(amount_sum) AS {_MONEY_SUM})"),
    "amount_squares": (
        f"try_sum(CAST(amount_spent * amount_spent AS {_SQUARES}))",
        "CASE WHEN count_if(amount_squares IS NULL AND amount_count > 0) = 0 THEN try_sum(amount_squares) END",
    ),
    "amount_squares_wide": (
        "sum(CAST(amount_spent AS DOUBLE) * CAST(amount_spent AS DOUBLE))",
        "sum(amount_squares_wide)",
    ),
    "amount_min": ("min(amount_spent)", "min(amount_min)"),
    "amount_max": ("max(amount_spent)", "max(amount_max)"),
    "age_count": ("count(age)", "sum(age_count)"),
    "age_sum": ("sum(age)", "sum(age_sum)"),
    "referred": ("count_if(referral IN ({yes}))", "sum(referred)"),
    "first_date": ("min(CAST(transaction_date AS DATE))", "min(first_date)"),
    "last_date": ("max(CAST(transaction_date AS DATE))", "max(last_date)"),
}


def measures(
    df: DataFrame, *keys: str, referral_yes: Sequence[str] = ("Yes",), extra: Sequence[Column] = ()
) -> DataFrame:
    """One row of additive measures per key; unused ones are pruned by the optimizer, `extra`
    aggregates ride along."""
    yes = ", ".join(sql_text(v) for v in referral_yes)
    return df.groupBy(*keys).agg(
        *[F.expr(f"{take.replace('{yes}', yes)} AS {name}") for name, (take, _) in MEASURES.items()], *extra
    )


def merge_measures(parts: DataFrame, *keys: str, extra: Sequence[Column] = ()) -> DataFrame:
    """Roll measures up to coarser keys; `extra` aggregates ride along."""
    return parts.groupBy(*keys).agg(
        *[F.expr(f"{merge} AS {name}") for name, (_, merge) in MEASURES.items()], *extra
    )


def ratio_sql(numerator: str, denominator: str) -> str:
    """Division as a double; NULL, never an error, when the denominator is zero or NULL."""
    return f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))"


def growth_sql(current: str, previous: str) -> str:
    """Relative change; 0 when there is no previous value, NULL when the previous value is 0."""
    change = ratio_sql(f"({current} - {previous})", previous)
    return f"CASE WHEN {previous} IS NOT NULL THEN {change} ELSE CAST(0 AS DOUBLE) END"


# Sample deviation from count, sum and sum of squares. n·Σx² − (Σx)² is taken in decimals, so
# nothing cancels and the result does not depend on how rows were split over tasks. Totals beyond
# 38 digits fall back to doubles.
_EXACT_SPREAD = (
    "CAST(try_subtract(try_multiply(CAST(amount_count AS DECIMAL(18,0)), amount_squares), "
    "try_multiply(amount_sum, amount_sum)) AS DOUBLE)"
)
_DOUBLE_SPREAD = (
    "CAST(amount_count AS DOUBLE) * amount_squares_wide "
    "- CAST(amount_sum AS DOUBLE) * CAST(amount_sum AS DOUBLE)"
)
SAMPLE_STDDEV = (
    f"CASE WHEN amount_count > 1 THEN sqrt(greatest(coalesce({_EXACT_SPREAD}, {_DOUBLE_SPREAD}), CAST(0 AS DOUBLE)) "
    "/ (CAST(amount_count AS DOUBLE) * (CAST(amount_count AS DOUBLE) - 1))) END"
)
