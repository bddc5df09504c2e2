"""Customer movement between quarters: new, returning and retained customers, volume growth.

Everything comes from one table of moves: for each (segment, state, customer, quarter) the
customer's previous active quarter in that group, counted up by (group, quarter, previous
quarter). Transactions are first reduced to one row per customer and quarter, with map-side
combining, so a customer holding a large part of all rows costs one row per quarter afterwards.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendgrain.functions.calendar import quarter_number, quarter_parts
from spendgrain.functions.measures import growth_sql, measures, ratio_sql
from spendgrain.operators.features import CUSTOMER_KEYS, QUARTER_KEYS, finish_quarterly, join_on_keys


def customer_moves(df: DataFrame, customer_col: str = "transaction_id") -> DataFrame:
    """(segment, state, quarter_no, previous_no, customers). A group and quarter in which only
    unknown customers were active stays, with 0 customers."""
    active = df.selectExpr(
        *CUSTOMER_KEYS, f"{customer_col} AS customer", f"{quarter_number('transaction_date')} AS quarter_no"
    ).distinct()
    own_quarters = Window.partitionBy(*CUSTOMER_KEYS, "customer").orderBy("quarter_no")
    return (
        active.withColumn("previous_no", F.lag("quarter_no").over(own_quarters))
        .groupBy(*CUSTOMER_KEYS, "quarter_no", "previous_no")
        .agg(F.count("customer").alias("customers"))
    )


def moves_of_unique_ids(parts: DataFrame) -> DataFrame:
    """The same table when the customer is the transaction_id and no id occurs twice: nobody comes
    back, so quarterly measures hold all of it and nothing is shuffled by customer."""
    return parts.selectExpr(
        *CUSTOMER_KEYS,
        "year * 4 + quarter - 1 AS quarter_no",
        "CAST(NULL AS INT) AS previous_no",
        "id_count AS customers",
    )


def cohort_counts(moves: DataFrame) -> DataFrame:
    """Per group and quarter: unique, new, returning and retained customers, retention rate.

    Retained means active in the group's previous present quarter too; the rate divides by the
    customers of that quarter and is NULL in a group's first quarter.
    """
    in_order = Window.partitionBy(*CUSTOMER_KEYS).orderBy("quarter_no")
    # The group's previous present quarter: the largest number below the row's own.
    earlier = in_order.rangeBetween(Window.unboundedPreceding, -1)
    per_quarter = (
        moves.withColumn("group_previous_no", F.max("quarter_no").over(earlier))
        .groupBy(*CUSTOMER_KEYS, "quarter_no")
        .agg(
            F.expr("sum(customers) AS unique_customers"),
            F.expr("coalesce(sum(customers) FILTER (WHERE previous_no IS NULL), 0) AS new_customers"),
            F.expr(
                "coalesce(sum(customers) FILTER (WHERE previous_no = group_previous_no), 0) AS retained_customers"
            ),
        )
    )
    return per_quarter.withColumn("earlier_customers", F.lag("unique_customers").over(in_order)).selectExpr(
        *CUSTOMER_KEYS,
        *[f"{sql} AS {name}" for name, sql in quarter_parts("quarter_no").items()],
        "unique_customers",
        "new_customers",
        "unique_customers - new_customers AS returning_customers",
        "retained_customers",
        f"{ratio_sql('retained_customers', 'earlier_customers')} AS customer_retention_rate",
    )


def customer_cohorts(df: DataFrame, customer_col: str = "transaction_id") -> DataFrame:
    return cohort_counts(customer_moves(df, customer_col)).select(
        *QUARTER_KEYS, "unique_customers", "new_customers", "returning_customers"
    )


def customer_retention(df: DataFrame, customer_col: str = "transaction_id") -> DataFrame:
    return cohort_counts(customer_moves(df, customer_col)).select(
        *QUARTER_KEYS, "unique_customers", "retained_customers", "customer_retention_rate"
    )


def transaction_growth(quarterly: DataFrame) -> DataFrame:
    """Add the growth of the transaction count to quarterly features."""
    in_order = Window.partitionBy(*CUSTOMER_KEYS).orderBy("year", "quarter")
    earlier = quarterly.withColumn("earlier_count", F.lag("quarterly_transactions").over(in_order))
    rate = F.expr(growth_sql("quarterly_transactions", "earlier_count"))
    return earlier.withColumn("transaction_growth_rate", rate).drop("earlier_count")


def full_quarterly(parts: DataFrame, cohorts: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Quarterly features with every declared column, from measures by QUARTER_KEYS and cohorts.

    unique_customers counts the customers the cohorts are about, so it is always the sum of the
    new and the returning ones.
    """
    extra = cohorts.select(
        *QUARTER_KEYS,
        F.col("unique_customers").alias("distinct_ids"),
        "new_customers",
        "returning_customers",
        "customer_retention_rate",
    )
    kept = ("new_customers", "returning_customers", "customer_retention_rate")
    joined = join_on_keys(parts, extra, QUARTER_KEYS)
    return transaction_growth(finish_quarterly(joined, as_of=as_of, extra=kept))


def payment_usage(df: DataFrame) -> DataFrame:
    """Transactions per payment method and segment, under the name usage_count."""
    return measures(df, "payment_method", "segment").select(
        "payment_method", "segment", F.col("id_count").alias("usage_count")
    )
