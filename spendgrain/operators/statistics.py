"""Run statistics of a set of transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrain.functions.measures import measures, ratio_sql
from spendgrain.operators.distributions import value_map
from spendgrain.schema import MONEY_SUM


STATISTICS = (
    "total_records",
    "date_range",
    "total_revenue",
    "avg_transaction",
    "unique_customers",
    "states_count",
    "segments",
    "payment_methods",
)


def ingestion_stats(df: DataFrame, ids_unique: bool = False) -> DataFrame:
    """One row with STATISTICS.

    Counts of ids and states take NULL as one more value; the two maps leave it out. Transactions
    are read once into counts by (segment, payment method, state). Only the distinct ids need
    another pass, which `ids_unique=True` (rows straight from one cleaning run) saves.
    """
    nothing = F.lit(None).cast("string")
    summary = _summary(df.withColumns({"reject_reason": nothing, "year_month": nothing}))
    unique = F.col("total_records") if ids_unique else distinct_with_null(df, "transaction_id").scalar()
    return summary.withColumn("unique_customers", unique).select(*STATISTICS)


def batch_summary(written: DataFrame) -> DataFrame:
    """One row about the judged rows of one cleaning run: STATISTICS of the accepted rows, the
    months they fall in, and the number of rejected rows per reason."""
    unique = _summary(written).withColumn("unique_customers", F.col("total_records"))
    return unique.select(*STATISTICS, "rejected")


def _summary(df: DataFrame) -> DataFrame:
    """Counts by every dimension at once, listed per (dimension, value) and folded into one row."""
    dimensions = ("segment", "payment_method", "state_names", "year_month")
    groups = measures(df, *dimensions, "reject_reason")
    entries = ", ".join(f"struct('{d}' AS dimension, {d} AS value)" for d in dimensions)
    accepted = f"array(struct('all' AS dimension, CAST(NULL AS STRING) AS value), {entries})"
    rejected = "array(struct('reject_reason' AS dimension, reject_reason AS value))"
    by_value = (
        groups.selectExpr("*", f"inline(CASE WHEN reject_reason IS NULL THEN {accepted} ELSE {rejected} END)")
        .groupBy("dimension", "value")
        .agg(
            F.expr("sum(row_count) AS n"),
            F.expr("sum(amount_sum) AS amount_sum"),
            F.expr("sum(amount_count) AS amount_count"),
            F.expr("min(first_date) AS first_date"),
            F.expr("max(last_date) AS last_date"),
        )
    )
    whole = "FILTER (WHERE dimension = 'all')"
    return by_value.groupBy().agg(
        F.expr(f"coalesce(max(n) {whole}, 0) AS total_records"),
        F.expr(
            f"struct(date_format(max(first_date) {whole}, 'yyyy-MM-dd') AS min, "
            f"date_format(max(last_date) {whole}, 'yyyy-MM-dd') AS max) AS date_range"
        ),
        F.expr(f"CAST(max(amount_sum) {whole} AS {MONEY_SUM.simpleString()}) AS total_revenue"),
        F.expr(f"{ratio_sql(f'max(amount_sum) {whole}', f'max(amount_count) {whole}')} AS avg_transaction"),
        F.expr("count_if(dimension = 'state_names') AS states_count"),
        F.expr(f"{value_map('segment')} AS segments"),
        F.expr(f"{value_map('payment_method')} AS payment_methods"),
        F.expr(f"{value_map('reject_reason')} AS rejected"),
    )


def distinct_with_null(df: DataFrame, column: str) -> DataFrame:
    """One value: distinct values of a column, NULL counted as one of them."""
    return df.groupBy(column).agg(F.lit(1).alias("one")).agg(F.count(F.lit(1)).alias("distinct_values"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), column)
    )


def monthly_counts(df: DataFrame) -> DataFrame:
    """Rows per (year, month) of dated transactions."""
    return df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count"))


def month_intake(judged: DataFrame) -> DataFrame:
    """Rows per calendar month of their date that the intake rules kept and rejected."""
    return (
        judged.filter(F.col("transaction_date").isNotNull())
        .groupBy(F.trunc(F.col("transaction_date").cast("date"), "month").alias("month_start"))
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if(F.col("reject_reason").isNull()).alias("records_kept"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("records_rejected"),
        )
    )
