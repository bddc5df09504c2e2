"""The training views and the report queries over feature sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrain.functions.keys import stable_key
from spendgrain.schema import FEATURE_VERSION


def ml_training_features(customer: DataFrame, quarterly: DataFrame, state: DataFrame) -> DataFrame:
    """Customer groups with their state totals and one row per quarter of the group.

    The quarterly table must carry customer_retention_rate (operators.cohorts.with_cohorts).
    """
    return _training_rows(customer, quarterly, state).orderBy(
        F.desc_nulls_first("total_amount_spent"), "segment", "state_names"
    ).withColumnRenamed("segment", "customer_segment")


def ml_training_latest(customer: DataFrame, quarterly: DataFrame, state: DataFrame) -> DataFrame:
    """As ml_training_features, with the latest quarter only: one training row per group."""
    latest = (
        quarterly.groupBy("segment", "state_names")
        .agg(
            F.max_by(
                F.struct("revenue_growth_rate", "customer_retention_rate"), F.struct("year", "quarter")
            ).alias("last")
        )
        .select("segment", "state_names", "last.*")
    )
    return ml_training_features(customer, latest, state)


def ml_training_features_alt(
    customer: DataFrame, quarterly: DataFrame, payment: DataFrame, state: DataFrame
) -> DataFrame:
    """The other declared view: quarters matched by state alone, payments by segment alone."""
    quarters = quarterly.select("state_names", F.col("revenue_growth_rate").alias("qoq_revenue_growth"))
    payments = payment.select("segment", F.col("usage_percentage").alias("payment_method_diversity"))
    states = state.select("state_names", F.col("total_revenue").alias("state_revenue"))
    return (
        customer.join(states, "state_names", "left")
        .join(quarters, "state_names", "left")
        .join(payments, "segment", "left")
        .select(
            stable_key("segment", "state_names").alias("feature_id"),
            F.col("segment").alias("customer_segment"),
            "state_names",
            "total_transactions",
            "total_amount_spent",
            "avg_transaction_amount",
            "days_active",
            "avg_age",
            "referral_rate",
            "qoq_revenue_growth",
            "payment_method_diversity",
            "state_revenue",
        )
    )


def ml_training_nested(customer: DataFrame, quarterly: DataFrame, payment: DataFrame, state: DataFrame) -> DataFrame:
    """The other view, one row per customer group: what it repeats for each pair of a quarter and a payment method stands here once, as
    the arrays `quarters` (of the state) and `payments` (of the segment). `flat_rows` is the number of rows it stands for."""
    by_state = quarterly.filter(F.col("state_names").isNotNull()).groupBy("state_names").agg(
        F.sort_array(F.collect_list(F.struct("year", "quarter", "segment", F.col("revenue_growth_rate").alias("qoq_revenue_growth")))).alias("quarters")
    )
    by_segment = payment.filter(F.col("segment").isNotNull()).groupBy("segment").agg(
        F.sort_array(F.collect_list(F.struct("payment_method", F.col("usage_percentage").alias("payment_method_diversity")))).alias("payments")
    )
    states = state.select("state_names", F.col("total_revenue").alias("state_revenue"))
    joined = customer.join(states, "state_names", "left").join(by_state, "state_names", "left").join(by_segment, "segment", "left")
    rows = [F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(1)) for c in ("quarters", "payments")]
    return joined.select(
        stable_key("segment", "state_names").alias("feature_id"),
        F.col("segment").alias("customer_segment"),
        "state_names",
        "total_transactions",
        "total_amount_spent",
        "avg_transaction_amount",
        "days_active",
        "avg_age",
        "referral_rate",
        "state_revenue",
        "quarters",
        "payments",
        (rows[0] * rows[1]).cast("long").alias("flat_rows"),
    )


def flatten_training(nested: DataFrame) -> DataFrame:
    """ml_training_features_alt from its nested form."""
    quarters = nested.select("*", F.explode_outer("quarters").alias("q")).select("*", F.explode_outer("payments").alias("p"))
    return quarters.select(
        "feature_id",
        "customer_segment",
        "state_names",
        "total_transactions",
        "total_amount_spent",
        "avg_transaction_amount",
        "days_active",
        "avg_age",
        "referral_rate",
        "q.qoq_revenue_growth",
        "p.payment_method_diversity",
        "state_revenue",
    )


def _training_rows(customer: DataFrame, quarterly: DataFrame, state: DataFrame) -> DataFrame:
    states = state.select(
        "state_names",
        F.col("total_revenue").alias("state_total_revenue"),
        F.col("avg_customer_value").alias("state_avg_customer_value"),
    )
    quarters = quarterly.select(
        "segment",
        "state_names",
        F.col("revenue_growth_rate").alias("quarterly_growth_rate"),
        F.col("customer_retention_rate").alias("retention_rate"),
    )
    return (
        customer.filter(F.col("feature_version") == FEATURE_VERSION)
        .select(
            "segment",
            "state_names",
            "total_transactions",
            "total_amount_spent",
            "avg_transaction_amount",
            "std_transaction_amount",
            "days_active",
            "avg_days_between_transactions",
            "avg_age",
            "referral_rate",
        )
        .join(states, "state_names", "left")
        .join(quarters, ["segment", "state_names"], "left")
        .select(
            "segment",
            "state_names",
            "total_transactions",
            "total_amount_spent",
            "avg_transaction_amount",
            "std_transaction_amount",
            "days_active",
            "avg_days_between_transactions",
            "avg_age",
            "referral_rate",
            "state_total_revenue",
            "state_avg_customer_value",
            "quarterly_growth_rate",
            "retention_rate",
        )
    )


def revenue_by_state(state: DataFrame) -> DataFrame:
    return state.select("state_names", "total_revenue")


def revenue_by_segment(customer: DataFrame) -> DataFrame:
    return customer.groupBy(F.col("segment").alias("customer_segment")).agg(
        F.sum("total_amount_spent").cast("decimal(28,2)").alias("revenue")
    )


def top_customer_groups(customer: DataFrame, n: int = 10) -> DataFrame:
    """First n groups by amount; segment and state settle ties."""
    return customer.orderBy(F.desc("total_amount_spent"), "segment", "state_names").limit(n)


def recent_executions(log: DataFrame, n: int = 10) -> DataFrame:
    return log.orderBy(F.desc("execution_date"), "pipeline_name").limit(n)


def store_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, in name order."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts.orderBy("table_name")


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make feature sets queryable by name with spark.sql."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
