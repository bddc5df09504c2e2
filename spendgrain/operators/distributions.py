"""Distributions of a dimension within (segment, state), as rows or as one map per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrain.operators.features import CUSTOMER_KEYS, join_on_keys

# Dimension column -> name of its map column in the customer feature table.
DISTRIBUTIONS = {
    "gender": "gender_distribution",
    "marital_status": "marital_status_distribution",
    "payment_method": "payment_method_distribution",
    "employees_status": "employment_status_distribution",
}


def distribution(df: DataFrame, dimension: str) -> DataFrame:
    """Long form: (segment, state, value, transactions)."""
    return df.groupBy(*CUSTOMER_KEYS, F.col(dimension).alias("value")).agg(
        F.count(F.lit(1)).alias("transactions")
    )


def distribution_maps(df: DataFrame) -> DataFrame:
    """All four distributions as map columns, one row per (segment, state).

    The transactions are counted once by every dimension together; the four maps are made from
    those counts, so a list entry is a distinct value of a category, never a transaction.
    """
    counts = df.groupBy(*CUSTOMER_KEYS, *DISTRIBUTIONS).agg(F.expr("count(1) AS n"))
    entries = ", ".join(f"struct('{d}' AS dimension, {d} AS value)" for d in DISTRIBUTIONS)
    by_value = (
        counts.selectExpr(*CUSTOMER_KEYS, "n", f"inline(array({entries}))")
        .groupBy(*CUSTOMER_KEYS, "dimension", "value")
        .agg(F.expr("sum(n) AS n"))
    )
    return by_value.groupBy(*CUSTOMER_KEYS).agg(
        *[F.expr(f"{value_map(dimension)} AS {name}") for dimension, name in DISTRIBUTIONS.items()]
    )


def value_map(dimension: str) -> str:
    """SQL aggregate over (dimension, value, n) rows: map of value -> n for one dimension, NULL
    values left out."""
    kept = f"FILTER (WHERE dimension = '{dimension}' AND value IS NOT NULL)"
    return f"map_from_entries(sort_array(collect_list(struct(value, n)) {kept}))"


def with_distributions(customer: DataFrame, df: DataFrame) -> DataFrame:
    """Customer features of `df` with the four map columns added."""
    return join_on_keys(customer, distribution_maps(df), CUSTOMER_KEYS)
