"""One feature run: the monthly table into feature sets, log row, snapshot and report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrain.functions.calendar import with_quarters
from spendgrain.functions.measures import measures, merge_measures
from spendgrain.operators import features as feature_sets
from spendgrain.operators.cohorts import cohort_counts, customer_moves, full_quarterly, moves_of_unique_ids
from spendgrain.operators.distributions import with_distributions
from spendgrain.operators.views import ml_training_features, register_views
from spendgrain.plans.ingestion import run_ingestion
from spendgrain.schema import STORE_KEYS, conform
from spendgrain.sources.files import accepted_rows, read_month_files, read_raw, read_stored
from spendgrain.sources.store import (
    LOG_TABLE,
    append_log,
    log_entry,
    read_features,
    read_log,
    write_features,
    write_jdbc,
    write_snapshot,
)

FEATURES = "quarterly_feature_refresh"
MEASURE_KEYS = ("year", "quarter", "segment", "state_names", "payment_method")


def run_features(
    spark: SparkSession,
    root: str,
    as_of: datetime | None = None,
    ids_unique: bool | None = None,
    customer_col: str = "transaction_id",
    snapshot_date: date | None = None,
    jdbc_url: str | None = None,
    jdbc_properties: dict[str, str] | None = None,
    referral_yes: Sequence[str] = ("Yes",),
    month_files: str | None = None,
) -> dict:
    """Compute the four feature sets from root/raw into root/features.

    The transactions are added up once, at the finest grain any feature set needs, and that small
    table is written; the feature sets are rolled up from it. What it cannot give (distinct ids,
    distributions, customer moves) reads only the columns it needs. Each table is computed once,
    by its write; later steps read it back.

    `ids_unique` says whether any transaction_id occurs twice. Left open, it is taken from the
    table: rows of a single ingestion run are unique by id, and then no id is ever shuffled.

    `month_files` names month files written elsewhere ('raw/*/*.parquet'), to be read instead of root/raw.
    """
    started = datetime.now()
    out = f"{root}/features"
    try:
        stored = read_month_files(spark, month_files) if month_files else read_stored(spark, f"{root}/raw")
        df = accepted_rows(stored)
        path = f"{out}/transaction_measures"
        parts = stored_measures(spark, df, path, referral_yes, batch_marks(stored))
        facts = parts.agg(
            F.expr("coalesce(sum(row_count), 0) AS records"),
            F.expr("coalesce(min(low_batch) = max(high_batch) AND sum(unmarked) = 0, false) AS one_batch"),
        ).first()
        if ids_unique is None:
            ids_unique = facts["one_batch"]
        computed = feature_tables(df, parts, as_of, ids_unique, customer_col)
        # Independent jobs: run side by side, small ones fill the slots the large ones leave.
        with ThreadPoolExecutor(len(computed)) as jobs:
            list(jobs.map(lambda item: write_features(item[1], out, item[0]), computed.items()))
        if jdbc_url or snapshot_date:
            for name in STORE_KEYS:
                table = read_features(spark, out, name)
                if jdbc_url:
                    write_jdbc(conform(table, name), name, "overwrite", jdbc_url, jdbc_properties)
                if snapshot_date:
                    write_snapshot(table, f"{root}/snapshots", name, snapshot_date)
    except Exception as error:
        append_log(spark, root, log_entry(FEATURES, "failed", 0, started, datetime.now(), error=str(error)))
        raise
    ended = datetime.now()
    append_log(spark, root, log_entry(FEATURES, "completed", facts["records"], started, ended))
    return {
        "status": "success",
        "records_processed": facts["records"],
        "execution_time": (ended - started).total_seconds(),
    }


def batch_marks(stored: DataFrame) -> list[Column]:
    """Aggregates that tell whether all rows come from one ingestion run, which keeps one row per id."""
    batch = "batch_id" if "batch_id" in stored.columns else "CAST(NULL AS STRING)"
    return [
        F.expr(f"min({batch}) AS low_batch"),
        F.expr(f"max({batch}) AS high_batch"),
        F.expr(f"count_if({batch} IS NULL) AS unmarked"),
    ]


def stored_measures(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    referral_yes: Sequence[str] = ("Yes",),
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Measures of the transactions at MEASURE_KEYS, written once and read back, so that several
    feature sets can be made from them without reading the transactions again."""
    parts = measures(with_quarters(df), *MEASURE_KEYS, referral_yes=referral_yes, extra=extra)
    parts.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def feature_tables(
    df: DataFrame,
    parts: DataFrame,
    as_of: datetime | None = None,
    ids_unique: bool = False,
    customer_col: str = "transaction_id",
) -> dict[str, DataFrame]:
    """All four feature sets with every declared column, from transactions and their measures."""
    quarter_parts = merge_measures(parts, *feature_sets.QUARTER_KEYS)
    if ids_unique and customer_col == "transaction_id":
        moves = moves_of_unique_ids(quarter_parts)
    else:
        moves = customer_moves(df, customer_col)
    customer = feature_sets.finish_customer(merge_measures(parts, *feature_sets.CUSTOMER_KEYS), as_of)
    return {
        "customer_features": with_distributions(customer, df),
        "quarterly_features": full_quarterly(quarter_parts, cohort_counts(moves), as_of),
        "payment_features": feature_sets.finish_payment(
            merge_measures(parts, *feature_sets.PAYMENT_KEYS),
            parts.agg(F.sum("row_count").alias("total")),
            as_of,
        ),
        "state_features": feature_sets.finish_state(
            merge_measures(parts, "state_names", "segment", "payment_method"),
            None if ids_unique else feature_sets.distinct_ids(df, "state_names"),
            as_of,
        ),
    }


def run_all(
    spark: SparkSession,
    csv_path: str,
    root: str,
    as_of: datetime | None = None,
    date_format: str = "yyyy-MM-dd",
    csv_options: Mapping[str, str] | None = None,
    **options,
) -> dict:
    """Ingestion, then features; `options` are those of run_features."""
    return {
        "ingestion": run_ingestion(spark, csv_path, root, as_of, date_format, csv_options),
        "features": run_features(spark, root, as_of, **options),
    }


def open_store(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The store's tables in their declared shape, and the training view, also as temporary views
    under the same names for spark.sql."""
    tables = {name: conform(read_features(spark, f"{root}/features", name), name) for name in STORE_KEYS}
    by_segment = {n: t.withColumnRenamed("customer_segment", "segment") for n, t in tables.items()}
    tables["ml_training_features"] = ml_training_features(
        by_segment["customer_features"], by_segment["quarterly_features"], by_segment["state_features"]
    )
    tables["raw_transactions"] = conform(read_raw(spark, f"{root}/raw"), "raw_transactions")
    tables[LOG_TABLE] = read_log(spark, root)
    register_views(tables)
    return tables


def stage_report(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, row_count, status) for the tables a run produced."""
    report = None
    for name, table in stages.items():
        one = table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("stage"),
            "row_count",
            F.when(F.col("row_count") > 0, "SUCCESS").otherwise("EMPTY").alias("status"),
        )
        report = one if report is None else report.unionByName(one)
    return report
