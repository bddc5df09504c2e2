"""Column names, fixed values and table schemas.

Feature-store tables keep the declared column names and decimal *scales*. Counts are BIGINT and
money sums DECIMAL(28,2) instead of INTEGER and DECIMAL(15,2): a total over 100 TB of transactions
does not fit the narrow types, and under ANSI mode the cast would fail the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Header names a transaction CSV must carry (exact, case-sensitive).
REQUIRED_COLUMNS = (
    "Transaction_date",
    "Transaction_ID",
    "Gender",
    "Age",
    "Marital_status",
    "State_names",
    "Segment",
    "Employees_status",
    "Payment_method",
    "Referral",
    "Amount_spent",
)

# Texts that pandas' CSV reader takes as missing by default.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# What a missing text becomes.
TEXT_DEFAULTS = {
    "gender": "Unknown",
    "marital_status": "Unknown",
    "state_names": "Unknown",
    "segment": "Regular",
    "employees_status": "Unknown",
    "payment_method": "Unknown",
    "referral": "No",
}

# Accepted ages (inclusive) and the version tag on every feature row.
MIN_AGE, MAX_AGE = 18, 120
FEATURE_VERSION = "v1"

# Declared widths of the raw table, VARCHAR(n) and DECIMAL(precision, scale).
TEXT_LIMITS = {
    "transaction_id": 50,
    "gender": 10,
    "marital_status": 20,
    "state_names": 50,
    "segment": 50,
    "employees_status": 50,
    "payment_method": 50,
    "referral": 10,
}
AMOUNT_LIMIT = (10, 2)

MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)
# Σ amount² keeps all four decimals; 38 digits is Spark's widest decimal.
MONEY_SQUARES = T.DecimalType(38, 4)
_MEAN = T.DecimalType(18, 2)
_RATE = T.DecimalType(18, 4)
_COUNT = T.LongType()
_COUNTS_BY_VALUE = T.MapType(T.StringType(), T.LongType())


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns])


CLEAN_SCHEMA = _table(
    ("transaction_date", T.TimestampNTZType()),
    ("transaction_id", T.StringType()),
    ("gender", T.StringType()),
    ("age", T.IntegerType()),
    ("marital_status", T.StringType()),
    ("state_names", T.StringType()),
    ("segment", T.StringType()),
    ("employees_status", T.StringType()),
    ("payment_method", T.StringType()),
    ("referral", T.StringType()),
    ("amount_spent", MONEY),
)

STORE_TABLES = {
    "raw_transactions": _table(
        ("transaction_id", T.StringType()),
        ("transaction_date", T.DateType()),
        ("gender", T.StringType()),
        ("age", T.IntegerType()),
        ("marital_status", T.StringType()),
        ("state_names", T.StringType()),
        ("segment", T.StringType()),
        ("employees_status", T.StringType()),
        ("payment_method", T.StringType()),
        ("referral", T.StringType()),
        ("amount_spent", MONEY),
        ("created_at", T.TimestampType()),
    ),
    "customer_features": _table(
        ("feature_id", T.StringType()),
        ("customer_segment", T.StringType()),
        ("state_names", T.StringType()),
        ("total_transactions", _COUNT),
        ("total_amount_spent", MONEY_SUM),
        ("avg_transaction_amount", _MEAN),
        ("min_transaction_amount", MONEY),
        ("max_transaction_amount", MONEY),
        ("std_transaction_amount", _MEAN),
        ("first_transaction_date", T.DateType()),
        ("last_transaction_date", T.DateType()),
        ("days_active", T.IntegerType()),
        ("avg_days_between_transactions", _MEAN),
        ("avg_age", _MEAN),
        ("gender_distribution", _COUNTS_BY_VALUE),
        ("marital_status_distribution", _COUNTS_BY_VALUE),
        ("payment_method_distribution", _COUNTS_BY_VALUE),
        ("referral_rate", _RATE),
        ("employment_status_distribution", _COUNTS_BY_VALUE),
        ("feature_version", T.StringType()),
        ("created_at", T.TimestampType()),
        ("updated_at", T.TimestampType()),
    ),
    "quarterly_features": _table(
        ("id", T.StringType()),
        ("year", T.IntegerType()),
        ("quarter", T.IntegerType()),
        ("customer_segment", T.StringType()),
        ("state_names", T.StringType()),
        ("quarterly_transactions", _COUNT),
        ("quarterly_revenue", MONEY_SUM),
        ("avg_quarterly_transaction", _MEAN),
        ("unique_customers", _COUNT),
        ("new_customers", _COUNT),
        ("returning_customers", _COUNT),
        ("revenue_growth_rate", _RATE),
        ("transaction_growth_rate", _RATE),
        ("customer_retention_rate", _RATE),
        ("feature_version", T.StringType()),
        ("created_at", T.TimestampType()),
    ),
    "payment_features": _table(
        ("id", T.StringType()),
        ("payment_method", T.StringType()),
        ("customer_segment", T.StringType()),
        ("total_transactions", _COUNT),
        ("total_amount", MONEY_SUM),
        ("avg_transaction_amount", _MEAN),
        ("usage_percentage", _RATE),
        ("feature_version", T.StringType()),
        ("created_at", T.TimestampType()),
    ),
    "state_features": _table(
        ("id", T.StringType()),
        ("state_names", T.StringType()),
        ("total_customers", _COUNT),
        ("total_transactions", _COUNT),
        ("total_revenue", MONEY_SUM),
        ("avg_customer_value", _MEAN),
        ("avg_transaction_size", _MEAN),
        ("avg_customer_age", _MEAN),
        ("top_segment", T.StringType()),
        ("top_payment_method", T.StringType()),
        ("feature_version", T.StringType()),
        ("created_at", T.TimestampType()),
        ("updated_at", T.TimestampType()),
    ),
    "pipeline_execution_log": _table(
        ("execution_id", T.StringType()),
        ("pipeline_name", T.StringType()),
        ("execution_date", T.TimestampType()),
        ("status", T.StringType()),
        ("records_processed", _COUNT),
        ("records_inserted", _COUNT),
        ("records_updated", _COUNT),
        ("records_failed", _COUNT),
        ("start_time", T.TimestampType()),
        ("end_time", T.TimestampType()),
        ("execution_time_seconds", T.LongType()),
        ("error_message", T.StringType()),
        ("metadata", T.MapType(T.StringType(), T.StringType())),
    ),
}

# Columns that identify one row of each feature table.
STORE_KEYS = {
    "customer_features": ("customer_segment", "state_names"),
    "quarterly_features": ("year", "quarter", "customer_segment", "state_names"),
    "payment_features": ("payment_method", "customer_segment"),
    "state_features": ("state_names",),
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Shape a feature set into its store table: column order, names, types, key column.

    Columns the input lacks come out as typed NULLs; a value too wide for its type fails the job
    (ANSI) rather than being cut.
    """
    from spendgrain.functions.keys import stable_key

    if "segment" in df.columns and table in STORE_KEYS:
        df = df.withColumnRenamed("segment", "customer_segment")
    schema = STORE_TABLES[table]
    key_column = schema.fields[0].name
    if table in STORE_KEYS and key_column not in df.columns:
        df = df.withColumn(key_column, stable_key(*STORE_KEYS[table]))
    if "updated_at" in schema.names and "updated_at" not in df.columns and "created_at" in df.columns:
        df = df.withColumn("updated_at", F.col("created_at"))
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
