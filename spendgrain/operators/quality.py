"""Data quality checks. Each returns a small table and reads its input once."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendgrain.functions.measures import ratio_sql
from spendgrain.functions.parsing import missing_to_null, money_sql, number_sql, timestamp_ntz_sql
from spendgrain.operators.cleaning import standard_names
from spendgrain.schema import AMOUNT_LIMIT, CLEAN_SCHEMA, MAX_AGE, MIN_AGE, TEXT_LIMITS


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_rows, total_rows)"""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return counted.unpivot(["total_rows"], list(columns), "column_name", "null_rows").select(
        "column_name", "null_rows", "total_rows"
    )


def event_freshness(df: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """(latest_date, days_behind, recent_rows, fresh) by transaction date."""
    day = F.col("transaction_date").cast("date")
    return df.agg(
        F.max(day).alias("latest_date"),
        F.count_if(day > F.lit(as_of - timedelta(days=days))).alias("recent_rows"),
    ).select(
        "latest_date",
        F.date_diff(F.lit(as_of), F.col("latest_date")).alias("days_behind"),
        "recent_rows",
        (F.col("recent_rows") > 0).alias("fresh"),
    )


def file_freshness(df: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """(recent_files): files of a file-backed table changed within the last `days` days."""
    changed = F.col("_metadata.file_modification_time")
    return (
        df.select(F.col("_metadata.file_path").alias("file"), changed.alias("changed"))
        .filter(F.col("changed") >= F.lit(as_of - timedelta(days=days)))
        .groupBy("file")
        .agg(F.lit(1).alias("one"))
        .agg(F.count(F.lit(1)).alias("recent_files"))
    )


def schema_differences(df: DataFrame, expected: T.StructType) -> list[tuple[str, str | None, str | None]]:
    """(column, expected type, actual type) wherever the two differ; names compare exactly."""
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [(c, want.get(c), have.get(c)) for c in sorted(want.keys() | have.keys()) if want.get(c) != have.get(c)]


def schema_check(text: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """(column_name, expected_type, present, unreadable_rows) of CSV text against the clean schema:
    a value is unreadable when it is not missing and still does not parse as its type."""
    named = standard_names(text)
    present = [f for f in CLEAN_SCHEMA.fields if f.name in named.columns]
    counted = named.agg(
        *[F.count_if(_unreadable(f.name, f.dataType, date_format)).alias(f.name) for f in present]
    )
    long = counted.unpivot([], [f.name for f in present], "column_name", "unreadable_rows")
    expected = F.create_map(
        *[F.lit(x) for f in CLEAN_SCHEMA.fields for x in (f.name, f.dataType.simpleString())]
    )
    pairs = F.collect_list(F.struct("column_name", "unreadable_rows"))
    every = long.groupBy().agg(F.map_from_entries(pairs).alias("m"))
    return every.select(F.explode(expected).alias("column_name", "expected_type"), "m").select(
        "column_name",
        "expected_type",
        F.map_contains_key("m", F.col("column_name")).alias("present"),
        F.coalesce(F.try_element_at("m", F.col("column_name")), F.lit(0)).alias("unreadable_rows"),
    )


def _unreadable(name: str, dtype: T.DataType, date_format: str) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        parsed = timestamp_ntz_sql(name, date_format)
    elif isinstance(dtype, T.IntegerType):
        parsed = number_sql(name)
    elif isinstance(dtype, T.DecimalType):
        parsed = money_sql(name)
    else:
        return F.lit(False)
    return missing_to_null(name).isNotNull() & F.expr(f"({parsed}) IS NULL")


def unique_check(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """(table_name, key_columns, duplicate_keys, surplus_rows)"""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count_if(F.col("n") > 1).alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
        )
        .select(
            F.lit(table).alias("table_name"),
            F.lit(",".join(keys)).alias("key_columns"),
            "duplicate_keys",
            "surplus_rows",
        )
    )


def not_null_check(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, violations)"""
    return null_counts(df, columns).select(
        F.lit(table).alias("table_name"), "column_name", F.col("null_rows").alias("violations")
    )


def limit_check(df: DataFrame) -> DataFrame:
    """(column_name, declared_limit, violations, widest): text longer than its VARCHAR(n), amounts with more
    whole digits than their DECIMAL(p, s)."""
    precision, scale = AMOUNT_LIMIT
    whole = F.floor(F.abs("amount_spent"))
    limits = {c: (f"VARCHAR({n})", F.length(c) > n, F.length(c).cast("long")) for c, n in TEXT_LIMITS.items()}
    limits["amount_spent"] = (
        f"DECIMAL({precision},{scale})",
        whole >= F.lit(10 ** (precision - scale)),
        F.length(whole.cast("string")).cast("long"),
    )
    one = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(declared).alias("declared_limit"),
                F.count_if(broken).alias("violations"),
                F.max(width).alias("widest"),
            ).alias(c)
            for c, (declared, broken, width) in limits.items()
        ]
    )
    return one.select(F.inline(F.array(*limits)))


def feature_invariants(
    df: DataFrame, customer: DataFrame, quarterly: DataFrame, payment: DataFrame, state: DataFrame
) -> DataFrame:
    """(invariant, passed): what must hold between the transactions and their feature sets."""
    n, total, amount = F.col("total_transactions"), "total_transactions", "total_amount_spent"
    base = df.agg(
        F.count("transaction_id").alias("ids"),
        F.count(F.lit(1)).alias("total_rows"),
        F.sum("amount_spent").cast("decimal(28,2)").alias("amount"),
        (F.min("age") >= MIN_AGE).alias("a"),
        (F.max("age") <= MAX_AGE).alias("b"),
        (F.min("amount_spent") >= 0).alias("c"),
    )
    # Four independent one-row summaries, each given to the checks by a scalar subquery.
    by_customer = customer.agg(
        F.struct(
            F.sum(total).alias("ids"),
            F.sum(amount).cast("decimal(28,2)").alias("amount"),
            F.min(
                (F.col("min_transaction_amount") <= F.col("avg_transaction_amount") + 1e-9)
                & (F.col("avg_transaction_amount") <= F.col("max_transaction_amount") + 1e-9)
            ).alias("ordered"),
            F.min(F.col("days_active") >= 0).alias("forward"),
            F.min(F.col("referral_rate").between(0, 1)).alias("rates"),
        )
    ).scalar()
    first = F.struct("year", "quarter")
    by_quarter = quarterly.agg(
        F.struct(
            F.sum("quarterly_transactions").alias("ids"),
            F.sum("quarterly_revenue").cast("decimal(28,2)").alias("amount"),
        )
    ).scalar()
    first_growth = (
        quarterly.groupBy("segment", "state_names")
        .agg(F.min_by("revenue_growth_rate", first).alias("growth"))
        .agg(F.min(F.col("growth") == 0))
        .scalar()
    )
    by_payment = payment.agg(
        F.struct(
            F.sum(n).alias("ids"),
            F.sum("total_amount").cast("decimal(28,2)").alias("amount"),
            F.sum("usage_percentage").alias("share"),
        )
    ).scalar()
    by_state = state.agg(
        F.struct(F.sum(n).alias("ids"), F.sum("total_revenue").cast("decimal(28,2)").alias("amount"))
    ).scalar()
    facts = base.select(
        "*",
        by_customer.alias("by_customer"),
        by_quarter.alias("by_quarter"),
        by_payment.alias("by_payment"),
        by_state.alias("by_state"),
        first_growth.alias("first_growth"),
    )
    checks = {
        "ages_in_range": F.col("a") & F.col("b"),
        "amounts_not_negative": F.col("c"),
        "ids_add_up_customer": F.col("by_customer.ids") == F.col("ids"),
        "ids_add_up_payment": F.col("by_payment.ids") == F.col("ids"),
        "ids_add_up_quarterly": F.col("by_quarter.ids") == F.col("ids"),
        "ids_add_up_state": F.col("by_state.ids") == F.col("ids"),
        "amounts_add_up_customer": F.col("by_customer.amount") == F.col("amount"),
        "amounts_add_up_payment": F.col("by_payment.amount") == F.col("amount"),
        "amounts_add_up_quarterly": F.col("by_quarter.amount") == F.col("amount"),
        "amounts_add_up_state": F.col("by_state.amount") == F.col("amount"),
        "average_between_extremes": F.col("by_customer.ordered"),
        "days_active_not_negative": F.col("by_customer.forward"),
        "referral_rate_is_a_share": F.col("by_customer.rates"),
        "first_quarter_growth_zero": F.col("first_growth"),
        # One, unless some rows have no id: the shares divide by all rows.
        "usage_adds_up": F.expr(f"abs(by_payment.share - {ratio_sql('ids', 'total_rows')}) < 1e-6"),
    }
    rows = [
        F.struct(F.lit(k).alias("invariant"), F.coalesce(v, F.lit(False)).alias("passed"))
        for k, v in checks.items()
    ]
    return facts.select(F.inline(F.array(*rows)))


def quality_report(text: DataFrame, typed: DataFrame, as_of: date) -> DataFrame:
    """(check, item, value, passed): missing values, freshness and unreadable values together."""
    named = standard_names(text)
    fields = [f for f in CLEAN_SCHEMA.fields if f.name in named.columns]
    counted = named.agg(
        *[F.count_if(F.col(f.name).isNull()).alias(f"nulls_{f.name}") for f in fields],
        *[F.count_if(_unreadable(f.name, f.dataType, "yyyy-MM-dd")).alias(f"schema_{f.name}") for f in fields],
    )
    rows = [_report_row(kind, f.name, F.col(f"{kind}_{f.name}")) for kind in ("nulls", "schema") for f in fields]
    # An absent column has no values, none of them readable.
    rows += [_report_row("schema", f.name, F.lit(0), passed=False) for f in CLEAN_SCHEMA.fields if f not in fields]
    fresh = event_freshness(typed, as_of).select(
        F.lit("freshness").alias("check"),
        F.lit("recent_rows").alias("item"),
        F.col("recent_rows").alias("value"),
        F.col("fresh").alias("passed"),
    )
    return counted.select(F.inline(F.array(*rows))).unionByName(fresh)


def _report_row(check: str, item: str, value: Column, passed: bool = True) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(item).alias("item"),
        value.cast("long").alias("value"),
        ((value == 0) & F.lit(passed)).alias("passed"),
    )
