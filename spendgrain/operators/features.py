"""The four feature sets.

Each takes cleaned transactions and returns one small table. The `finish_*` halves take additive
measures instead, so a run that has measures at a finer grain already need not read the
transactions again (see plans/refresh.py).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendgrain.functions.calendar import with_quarters
from spendgrain.functions.measures import SAMPLE_STDDEV, growth_sql, measures, merge_measures, ratio_sql
from spendgrain.functions.tagging import tag_features

CUSTOMER_KEYS = ("segment", "state_names")
QUARTER_KEYS = ("year", "quarter", "segment", "state_names")
PAYMENT_KEYS = ("payment_method", "segment")


def customer_features(
    df: DataFrame, as_of: datetime | None = None, referral_yes: tuple[str, ...] = ("Yes",)
) -> DataFrame:
    """Per (segment, state): counts, sums, spread, activity span, age, referral rate."""
    return finish_customer(measures(df, *CUSTOMER_KEYS, referral_yes=referral_yes), as_of)


def finish_customer(parts: DataFrame, as_of: datetime | None = None) -> DataFrame:
    days = "date_diff(last_date, first_date)"
    result = parts.selectExpr(
        *CUSTOMER_KEYS,
        "id_count AS total_transactions",
        "amount_sum AS total_amount_spent",
        f"{ratio_sql('amount_sum', 'amount_count')} AS avg_transaction_amount",
        "amount_min AS min_transaction_amount",
        "amount_max AS max_transaction_amount",
        f"{SAMPLE_STDDEV} AS std_transaction_amount",
        "first_date AS first_transaction_date",
        "last_date AS last_transaction_date",
        f"{ratio_sql('age_sum', 'age_count')} AS avg_age",
        f"{ratio_sql('referred', 'row_count')} AS referral_rate",
        f"{days} AS days_active",
        # Divides by the number of transactions, not by the number of gaps between them.
        f"{ratio_sql(days, 'id_count')} AS avg_days_between_transactions",
    )
    return tag_features(result, as_of)


def quarterly_features(df: DataFrame, as_of: datetime | None = None, ids_unique: bool = False) -> DataFrame:
    """Per (year, quarter, segment, state): volume, revenue, distinct ids, revenue growth.

    `ids_unique=True` says that no transaction_id occurs twice (as straight after one cleaning
    run); distinct ids are then the id count and the shuffle of every id is saved.
    """
    dated = with_quarters(df)
    parts = measures(dated, *QUARTER_KEYS)
    return finish_quarterly(parts, None if ids_unique else distinct_ids(dated, *QUARTER_KEYS), as_of)


def finish_quarterly(
    parts: DataFrame,
    distinct: DataFrame | None = None,
    as_of: datetime | None = None,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """`extra` columns of `parts` are passed through."""
    parts = _with_distinct_ids(parts, distinct, QUARTER_KEYS)
    by_time = Window.partitionBy(*CUSTOMER_KEYS).orderBy("year", "quarter")
    result = parts.withColumn("previous_sum", F.lag("amount_sum").over(by_time)).selectExpr(
        *QUARTER_KEYS,
        "id_count AS quarterly_transactions",
        "amount_sum AS quarterly_revenue",
        f"{ratio_sql('amount_sum', 'amount_count')} AS avg_quarterly_transaction",
        "distinct_ids AS unique_customers",
        f"{growth_sql('amount_sum', 'previous_sum')} AS revenue_growth_rate",
        *extra,
    )
    return tag_features(result, as_of)


def payment_features(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Per (payment method, segment): volume, revenue, share of all rows as a fraction."""
    return finish_payment(measures(df, *PAYMENT_KEYS), df.agg(F.count(F.lit(1)).alias("total")), as_of)


def finish_payment(parts: DataFrame, total: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """`total` is a one-row, one-column table with the number of transactions."""
    result = parts.withColumn("all_rows", total.scalar()).selectExpr(
        *PAYMENT_KEYS,
        "id_count AS total_transactions",
        "amount_sum AS total_amount",
        f"{ratio_sql('amount_sum', 'amount_count')} AS avg_transaction_amount",
        f"{ratio_sql('id_count', 'all_rows')} AS usage_percentage",
    )
    return tag_features(result, as_of)


def state_features(df: DataFrame, as_of: datetime | None = None, ids_unique: bool = False) -> DataFrame:
    """Per state: customers, revenue, averages, most used segment and payment method."""
    parts = measures(df, "state_names", "segment", "payment_method")
    return finish_state(parts, None if ids_unique else distinct_ids(df, "state_names"), as_of)


def finish_state(parts: DataFrame, distinct: DataFrame | None, as_of: datetime | None = None) -> DataFrame:
    """`parts` holds measures at (state, segment, payment method) or finer.

    Both tops come out of the same small pre-aggregate by window sums, so the transactions are
    not grouped three times.
    """
    ranked = parts.selectExpr(
        "*",
        "struct(-sum(id_count) OVER (PARTITION BY state_names, segment) AS n, segment AS value) AS segment_rank",
        "struct(-sum(id_count) OVER (PARTITION BY state_names, payment_method) AS n, payment_method AS value) "
        "AS payment_rank",
    )
    states = merge_measures(
        ranked,
        "state_names",
        extra=[F.expr("min(segment_rank) AS segment_rank"), F.expr("min(payment_rank) AS payment_rank")],
    )
    result = _with_distinct_ids(states, distinct, ("state_names",)).selectExpr(
        "state_names",
        "distinct_ids AS total_customers",
        "id_count AS total_transactions",
        "amount_sum AS total_revenue",
        f"{ratio_sql('amount_sum', 'amount_count')} AS avg_transaction_size",
        f"{ratio_sql('age_sum', 'age_count')} AS avg_customer_age",
        f"{ratio_sql('amount_sum', 'distinct_ids')} AS avg_customer_value",
        # The most used values belong to named states only; the group without a state gets none.
        "CASE WHEN state_names IS NOT NULL THEN segment_rank.value END AS top_segment",
        "CASE WHEN state_names IS NOT NULL THEN payment_rank.value END AS top_payment_method",
    )
    return tag_features(result, as_of)


def top_value_per_state(df: DataFrame, value: str, count_name: str, top_name: str) -> DataFrame:
    """The most frequent value per state; ties go to the alphabetically first."""
    best_first = Window.partitionBy("state_names").orderBy(F.desc(count_name), F.asc(value))
    return (
        df.groupBy("state_names", value)
        .agg(F.count("transaction_id").alias(count_name))
        .withColumn("rank", F.row_number().over(best_first))
        .filter("rank = 1")
        .select("state_names", F.col(value).alias(top_name), count_name)
    )


def distinct_ids(df: DataFrame, *keys: str, column: str = "transaction_id") -> DataFrame:
    """Distinct non-null ids per key. Spark first groups by (key, id), so one hot key is spread
    over all tasks."""
    return df.groupBy(*keys).agg(F.count_distinct(column).alias("distinct_ids"))


def approx_customers(df: DataFrame, *keys: str, column: str = "transaction_id", rsd: float = 0.02) -> DataFrame:
    """Sketch-based distinct count: a fixed-size sketch per key instead of a shuffle of every id."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(column, rsd).alias("approx_customers"))


def checked_customers(df: DataFrame, *keys: str, column: str = "transaction_id", rsd: float = 0.02) -> DataFrame:
    """The exact distinct count beside the sketch, and whether they are within three deviations of the sketch.

    The estimate is a whole number, so the bound is rounded up to one; a group of a dozen may be off by one."""
    counted = df.groupBy(*keys).agg(
        F.count_distinct(column).alias("customers"),
        F.approx_count_distinct(column, rsd).alias("approx_customers"),
    )
    off = F.abs(F.col("approx_customers") - F.col("customers"))
    return counted.withColumn("within_bounds", off <= F.ceil(3 * rsd * F.col("customers")))


def _with_distinct_ids(parts: DataFrame, distinct: DataFrame | None, keys: tuple[str, ...]) -> DataFrame:
    """Measures with the distinct ids per key: joined in, there already, or equal to the id count."""
    if distinct is None:
        return parts if "distinct_ids" in parts.columns else parts.withColumn("distinct_ids", F.col("id_count"))
    return join_on_keys(parts, distinct, keys)


def join_on_keys(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Left join on grouping keys in which NULL matches NULL, as GROUP BY makes it a group."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    matches = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, matches, "left").drop(*[f"_right_{k}" for k in keys])
