"""Registered queries: one per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrain.functions.calendar import with_months, with_quarters
from spendgrain.functions.measures import measures, merge_measures
from spendgrain.operators import cleaning, cohorts, distributions, formats, frequent, quality, selection, sketches, statistics, views
from spendgrain.operators import features as fs
from spendgrain.plans.ingestion import run_ingestion
from spendgrain.plans.refresh import open_store, run_all, stage_report, stored_measures
from spendgrain.schema import conform
from spendgrain.sources.files import BAD_RECORD, FILE_ORDER, inventory, read_csv, read_raw, read_stored, rejected_rows, write_monthly
from spendgrain.sources.scratch import scratch_folder
from spendgrain.sources.store import read_features, read_log, with_snapshot_date, write_snapshot
from spendgrain.sources.testdata import dirty_transactions, table, transactions
from spendgrain.streaming.exact import exact_quarterly, exact_transactions, start_exact_intake
from spendgrain.streaming.medians import RANK_ERROR, add_ages, median_so_far
from spendgrain.streaming.intake import read_csv_stream, start_intake, stored_quarterly

Query = Callable[[SparkSession, str], DataFrame]

CUSTOMER = "customer_key"
AS_OF = date(2001, 8, 8)
SNAPSHOT = date(2001, 10, 1)
ORDER = ["seq"]
TEXT_COLUMNS = (
    "transaction_date transaction_id gender age marital_status state_names segment employees_status "
    "payment_method referral amount_spent"
).split()


def _result(df: DataFrame) -> DataFrame:
    """Feature rows without the run time; the deviation to four decimals, since engines add up
    in different orders."""
    if "std_transaction_amount" in df.columns:
        df = df.withColumn("std_transaction_amount", F.round("std_transaction_amount", 4))
    return df.drop("created_at")


def _customer(spark: SparkSession, sf: str) -> DataFrame:
    return fs.customer_features(transactions(spark, sf))


def _shared_measures(spark: SparkSession, tx: DataFrame) -> DataFrame:
    """Measures for queries over several feature sets: the transactions are added up once."""
    return stored_measures(spark, tx, scratch_folder(spark, "measures"))


def _sets_without_distinct_ids(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All four feature sets for queries that look at no distinct count, so no id is shuffled."""
    parts = _shared_measures(spark, transactions(spark, sf))
    counts = ("unique_customers", "total_customers", "avg_customer_value")
    return {
        "customer_features": fs.finish_customer(merge_measures(parts, *fs.CUSTOMER_KEYS)),
        "quarterly_features": fs.finish_quarterly(merge_measures(parts, *fs.QUARTER_KEYS)).drop(*counts),
        "payment_features": fs.finish_payment(
            merge_measures(parts, *fs.PAYMENT_KEYS), parts.agg(F.expr("sum(row_count) AS total"))
        ),
        "state_features": fs.finish_state(parts, None).drop(*counts),
    }


def _training_sets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customer, full quarterly (with retention) and state features."""
    tx = transactions(spark, sf)
    parts = _shared_measures(spark, tx)
    counts = cohorts.cohort_counts(cohorts.customer_moves(tx, CUSTOMER))
    return (
        fs.finish_customer(merge_measures(parts, *fs.CUSTOMER_KEYS)),
        cohorts.full_quarterly(merge_measures(parts, *fs.QUARTER_KEYS), counts),
        fs.finish_state(parts, fs.distinct_ids(tx, "state_names")),
    )


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean(dirty_transactions(spark, sf), ORDER)


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("transaction_date", F.col("transaction_date").cast("date"))


# sources and sinks


def _dirty_csv(spark: SparkSession, sf: str) -> str:
    """The dirty rows as CSV files whose name order is the row order."""
    return _as_csv(spark, dirty_transactions(spark, sf))


def _as_csv(spark: SparkSession, rows: DataFrame) -> str:
    folder = scratch_folder(spark, "csv")
    rows.orderBy("seq").drop("seq").write.option("header", True).option("escape", '"').csv(folder)
    return folder


def src_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.standard_names(read_csv(spark, _dirty_csv(spark, sf)).drop(*FILE_ORDER, BAD_RECORD))


def csv_quoted_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh row with a line break in its state: read by lines, its two halves are bad records;
    read by records, nothing is lost."""
    state = F.expr("CASE WHEN seq % 7 = 0 THEN 'New\nYork' ELSE State_names END")
    folder = _as_csv(spark, dirty_transactions(spark, sf).withColumn("State_names", state))
    counts = [
        F.count(F.lit(1)).alias("rows_in"),
        F.count(BAD_RECORD).alias("bad_records"),
        F.count_if(F.col(BAD_RECORD).isNull() & (F.col("State_names") == "New\nYork")).alias("broken_states"),
    ]
    by_line = read_csv(spark, folder).agg(F.lit("lines").alias("read_by"), *counts)
    return by_line.unionByName(read_csv(spark, folder, multiLine="true").agg(F.lit("records").alias("read_by"), *counts))


def csv_quoted_records(spark: SparkSession, sf: str) -> DataFrame:
    """The rows as read from files with line breaks in states and in the last column, split and read in parallel."""
    state = F.expr("CASE WHEN seq % 7 = 0 THEN 'New\nYork \"NY\"' ELSE State_names END")
    amount = F.expr("CASE WHEN seq % 11 = 0 THEN concat(Amount_spent, '\nnet, \"') ELSE Amount_spent END")
    folder = _as_csv(spark, dirty_transactions(spark, sf).withColumns({"State_names": state, "Amount_spent": amount}))
    return cleaning.standard_names(read_csv(spark, folder, quotedBreaks="true").drop(*FILE_ORDER))


def rejected_after_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two ingestion runs into one store; what each one rejected is still there."""
    root, rows = scratch_folder(spark, "store"), dirty_transactions(spark, sf)
    for part in (0, 1):
        run_ingestion(spark, _as_csv(spark, rows.filter(F.col("seq") % 2 == part)), root)
    rejected = rejected_rows(read_stored(spark, f"{root}/raw"))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("row_count"))


def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return transactions(spark, sf)


def monthly_partition_counts(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_folder(spark, "raw")
    write_monthly(transactions(spark, sf), folder)
    return statistics.monthly_counts(read_raw(spark, folder))


def raw_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return conform(transactions(spark, sf), "raw_transactions").drop("created_at")


def raw_count(spark: SparkSession, sf: str) -> DataFrame:
    return transactions(spark, sf).agg(F.count(F.lit(1)).alias("row_count"))


def raw_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return inventory(table(spark, sf, "orders").withColumnRenamed("o_orderdate", "transaction_date"))


# cleaning


def clean_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(cleaning.accepted(_judged(spark, sf)))


def age_median_fill(spark: SparkSession, sf: str) -> DataFrame:
    profile = cleaning.age_profile(cleaning.parse(dirty_transactions(spark, sf)))
    return profile.select("rows_in", "missing_age", "median_age")


def amount_coerce(spark: SparkSession, sf: str) -> DataFrame:
    parsed = cleaning.parse(dirty_transactions(spark, sf))
    return cleaning.fill_missing(parsed, 0).select("seq", "amount_spent")


def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.standard_names(dirty_transactions(spark, sf))
    return cleaning.keep_first(rows, ORDER).select("seq", "transaction_id", "amount_spent")


def dedup_report(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.copies_report(cleaning.standard_names(dirty_transactions(spark, sf)))


def filter_valid(spark: SparkSession, sf: str) -> DataFrame:
    """The age and amount rules on every parsed row, copies included."""
    parsed = cleaning.parse(dirty_transactions(spark, sf))
    return cleaning.accepted(cleaning.judge(cleaning.fill_missing(parsed))).select("seq", "age", "amount_spent")


def quarantine_bad_dates(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.quarantined(_judged(spark, sf)).select(
        "seq", "transaction_id", "age", "state_names", "segment", "amount_spent", "reject_reason"
    )


def derive_calendar(spark: SparkSession, sf: str) -> DataFrame:
    dated = with_quarters(with_months(transactions(spark, sf)))
    return dated.select("transaction_id", "year", "month", "year_month", "quarter")


def cleaning_report(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.cleaning_report(dirty_transactions(spark, sf), ORDER)


# feature sets and views


def customer_features(spark: SparkSession, sf: str) -> DataFrame:
    return _result(_customer(spark, sf))


def quarterly_features(spark: SparkSession, sf: str) -> DataFrame:
    return _result(fs.quarterly_features(transactions(spark, sf)))


def payment_features(spark: SparkSession, sf: str) -> DataFrame:
    return _result(fs.payment_features(transactions(spark, sf)))


def state_features(spark: SparkSession, sf: str) -> DataFrame:
    return _result(fs.state_features(transactions(spark, sf)))


def top_segment_per_state(spark: SparkSession, sf: str) -> DataFrame:
    return fs.top_value_per_state(transactions(spark, sf), "segment", "transaction_count", "top_segment")


def top_payment_per_state(spark: SparkSession, sf: str) -> DataFrame:
    return fs.top_value_per_state(
        transactions(spark, sf), "payment_method", "payment_count", "top_payment_method"
    )


def ml_training_features(spark: SparkSession, sf: str) -> DataFrame:
    return _result(views.ml_training_features(*_training_sets(spark, sf)))


def ml_training_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _result(views.ml_training_latest(*_training_sets(spark, sf)))


def ml_training_features_alt(spark: SparkSession, sf: str) -> DataFrame:
    sets = _sets_without_distinct_ids(spark, sf)
    return views.ml_training_features_alt(
        sets["customer_features"], sets["quarterly_features"], sets["payment_features"], sets["state_features"]
    )


def ml_training_nested(spark: SparkSession, sf: str) -> DataFrame:
    """The nested view with the counts of its arrays, and sums over the rows that it stands for."""
    sets = _sets_without_distinct_ids(spark, sf)
    nested = views.ml_training_nested(
        sets["customer_features"], sets["quarterly_features"], sets["payment_features"], sets["state_features"]
    )
    shares = F.aggregate("payments", F.lit(0.0), lambda a, p: a + p["payment_method_diversity"])
    growth = F.aggregate("quarters", F.lit(0.0), lambda a, q: a + F.coalesce(q["qoq_revenue_growth"], F.lit(0.0)))
    return nested.select(
        "customer_segment",
        "state_names",
        "total_transactions",
        "total_amount_spent",
        "state_revenue",
        F.size("quarters").cast("long").alias("n_quarters"),
        F.size("payments").cast("long").alias("n_payments"),
        "flat_rows",
        F.round(growth * F.size("payments"), 4).alias("flat_growth"),
        F.round(shares * F.size("quarters"), 4).alias("flat_shares"),
    )


def revenue_by_state(spark: SparkSession, sf: str) -> DataFrame:
    parts = measures(transactions(spark, sf), "state_names", "segment", "payment_method")
    return views.revenue_by_state(fs.finish_state(parts, None))


def revenue_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    return views.revenue_by_segment(_customer(spark, sf))


def top_customer_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _result(views.top_customer_groups(_customer(spark, sf)))


def store_counts(spark: SparkSession, sf: str) -> DataFrame:
    return views.store_counts(_sets_without_distinct_ids(spark, sf))


def feature_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return with_snapshot_date(_result(_customer(spark, sf)), SNAPSHOT)


# statistics and logs


def ingestion_stats(spark: SparkSession, sf: str) -> DataFrame:
    """The statistics with the date range flattened and the two maps as JSON text."""
    stats = statistics.ingestion_stats(transactions(spark, sf))
    return stats.select(
        "total_records",
        F.col("date_range.min").alias("min_date"),
        F.col("date_range.max").alias("max_date"),
        "total_revenue",
        "avg_transaction",
        "unique_customers",
        "states_count",
        F.to_json("segments").alias("segments"),
        F.to_json("payment_methods").alias("payment_methods"),
    )


def segment_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return statistics.value_counts(transactions(spark, sf), "segment")


def payment_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return statistics.value_counts(transactions(spark, sf), "payment_method")


def approx_customers(spark: SparkSession, sf: str) -> DataFrame:
    """The sketch against the exact count; the estimate itself is Spark's own and not compared."""
    return fs.checked_customers(transactions(spark, sf), *fs.CUSTOMER_KEYS, column=CUSTOMER).drop("approx_customers")


def month_intake(spark: SparkSession, sf: str) -> DataFrame:
    return statistics.month_intake(_judged(spark, sf))


def _whole_run(spark: SparkSession, sf: str) -> str:
    """Ingestion and features from the dirty CSV files; the root of the store."""
    root = scratch_folder(spark, "run")
    run_all(spark, _dirty_csv(spark, sf), root)
    return root


def _log_columns(log: DataFrame) -> DataFrame:
    """A log without the times and ids of its runs."""
    counts = ("records_processed", "records_inserted", "records_updated", "records_failed")
    return log.select("pipeline_name", "status", *[F.col(c).cast("long").alias(c) for c in counts])


def execution_log(spark: SparkSession, sf: str) -> DataFrame:
    return _log_columns(read_log(spark, _whole_run(spark, sf)))


def recent_executions(spark: SparkSession, sf: str) -> DataFrame:
    return _log_columns(views.recent_executions(read_log(spark, _whole_run(spark, sf))))


def run_all_features(spark: SparkSession, sf: str) -> DataFrame:
    """Customer features as a whole run stored them."""
    stored = read_features(spark, f"{_whole_run(spark, sf)}/features", "customer_features")
    return stored.select("segment", "state_names", "total_transactions", "total_amount_spent")


def run_report(spark: SparkSession, sf: str) -> DataFrame:
    return stage_report({"raw_transactions": transactions(spark, sf), **_sets_without_distinct_ids(spark, sf)})


# declared columns


def gender_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return distributions.distribution(transactions(spark, sf), "gender")


def marital_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return distributions.distribution(transactions(spark, sf), "marital_status")


def payment_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return distributions.distribution(transactions(spark, sf), "payment_method")


def employment_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return distributions.distribution(transactions(spark, sf), "employees_status")


def distribution_maps(spark: SparkSession, sf: str) -> DataFrame:
    """All four distributions per group, as JSON text."""
    maps = distributions.distribution_maps(transactions(spark, sf))
    return maps.withColumns({c: F.to_json(c) for c in distributions.DISTRIBUTIONS.values()})


def customer_cohorts(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.customer_cohorts(transactions(spark, sf), CUSTOMER)


def customer_retention(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.customer_retention(transactions(spark, sf), CUSTOMER)


def transaction_growth(spark: SparkSession, sf: str) -> DataFrame:
    parts = measures(with_quarters(transactions(spark, sf)), *fs.QUARTER_KEYS)
    return cohorts.transaction_growth(fs.finish_quarterly(parts)).select(
        *fs.QUARTER_KEYS, "quarterly_transactions", "transaction_growth_rate"
    )


def payment_usage(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.payment_usage(transactions(spark, sf))


# data quality


def dq_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_counts(cleaning.standard_names(dirty_transactions(spark, sf)), TEXT_COLUMNS)


def dq_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.event_freshness(transactions(spark, sf), AS_OF)


def dq_schema(spark: SparkSession, sf: str) -> DataFrame:
    return quality.schema_check(dirty_transactions(spark, sf))


def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(dirty_transactions(spark, sf), transactions(spark, sf), AS_OF)


def dq_feature_invariants(spark: SparkSession, sf: str) -> DataFrame:
    sets = _sets_without_distinct_ids(spark, sf)
    return quality.feature_invariants(
        transactions(spark, sf),
        sets["customer_features"],
        sets["quarterly_features"],
        sets["payment_features"],
        sets["state_features"],
    )


def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    source = cleaning.standard_names(dirty_transactions(spark, sf))
    sets = _sets_without_distinct_ids(spark, sf)
    return (
        quality.unique_check(source, "source", ["transaction_id"])
        .unionByName(quality.unique_check(transactions(spark, sf), "raw_transactions", ["transaction_id"]))
        .unionByName(quality.unique_check(sets["quarterly_features"], "quarterly_features", fs.QUARTER_KEYS))
        .unionByName(
            quality.unique_check(sets["state_features"], "state_features", ["state_names", "feature_version"])
        )
    )


def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    parsed = cleaning.parse(dirty_transactions(spark, sf))
    checks = quality.not_null_check(parsed, "source", ["transaction_id", "transaction_date"])
    sets = _sets_without_distinct_ids(spark, sf)
    required = {
        "quarterly_features": ["year", "quarter"],
        "payment_features": ["payment_method"],
        "state_features": ["state_names"],
    }
    for name, columns in required.items():
        checks = checks.unionByName(quality.not_null_check(sets[name], name, columns))
    return checks


def dq_limits(spark: SparkSession, sf: str) -> DataFrame:
    return quality.limit_check(transactions(spark, sf))


# streaming


def _streamed(spark: SparkSession, sf: str) -> str:
    """Take the dirty CSV files in as a stream; the root of the tables it fills."""
    csv, root = _dirty_csv(spark, sf), scratch_folder(spark, "stream")
    profile = cleaning.age_profile(cleaning.parse(read_csv(spark, csv)))
    median = profile.first()["median_age"]
    start_intake(read_csv_stream(spark, csv), root, f"{root}/checkpoint", median).awaitTermination()
    return root


def stream_intake(spark: SparkSession, sf: str) -> DataFrame:
    return _by_month(read_raw(spark, f"{_streamed(spark, sf)}/raw"))


def _by_month(raw: DataFrame) -> DataFrame:
    return raw.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("amount_spent").cast("decimal(28,2)").alias("amount")
    )


def stream_quarterly(spark: SparkSession, sf: str) -> DataFrame:
    return _result(stored_quarterly(spark, _streamed(spark, sf)))


# counts that merge, selection, frequent values


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    folder = scratch_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def sketched_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Stored sketches and bitmaps rolled up to every grain: the exact count, and whether the estimate is within its bound."""
    tx = transactions(spark, sf)
    kept = _stored(spark, sketches.customer_sketches(tx, CUSTOMER), "sketches")
    exact = _stored(spark, sketches.customer_bitmaps(tx, CUSTOMER), "bitmaps")
    grains = {"quarter": (*fs.CUSTOMER_KEYS, "quarter_no"), "group": fs.CUSTOMER_KEYS, "state": ("state_names",), "all": ()}
    every = None
    for grain, keys in grains.items():
        mark = F.lit(grain).alias("grain")
        counted = sketches.counted_customers(exact, *keys).select(mark, "*")
        estimated = sketches.distinct_customers(kept, *keys).select(mark, "*")
        both = fs.join_on_keys(counted, estimated, ("grain", *keys))
        close = (F.abs(F.col("customers") - F.col("customers_estimate")) <= F.col("bound")).alias("within_bounds")
        one = both.select("grain", *keys, "customers", close)
        every = one if every is None else every.unionByName(one, allowMissingColumns=True)
    return every


def sketched_cohorts(spark: SparkSession, sf: str) -> DataFrame:
    """Cohorts from theta sketches against those that meet every customer."""
    tx = transactions(spark, sf)
    sketched = sketches.sketch_cohorts(_stored(spark, sketches.customer_sketches(tx, CUSTOMER), "sketches"))
    return sketches.checked_cohorts(sketched, cohorts.cohort_counts(cohorts.customer_moves(tx, CUSTOMER)))


def bitmap_cohorts(spark: SparkSession, sf: str) -> DataFrame:
    return sketches.bitmap_cohorts(_stored(spark, sketches.customer_bitmaps(transactions(spark, sf), CUSTOMER), "bitmaps"))


def exact_medians(spark: SparkSession, sf: str) -> DataFrame:
    columns = {"amount_spent": transactions(spark, sf), "l_extendedprice": table(spark, sf, "lineitem"), "l_quantity": table(spark, sf, "lineitem")}
    rows = [(name, *selection.exact_median(df, name)) for name, df in columns.items()]
    return spark.createDataFrame(rows, "column_name string, row_count long, median double").withColumn("median", F.round("median", 4))


def frequent_customers(spark: SparkSession, sf: str) -> DataFrame:
    return frequent.frequent_values(transactions(spark, sf), CUSTOMER, share=0.001)


def date_formats(spark: SparkSession, sf: str) -> DataFrame:
    """Which pattern reads the dates of three parts of the dirty rows: one as they are, one written day first, one mixed."""
    day_first = F.expr(
        "CASE WHEN seq % 3 = 1 OR (seq % 3 = 2 AND seq % 2 = 0) THEN coalesce(date_format(try_cast(Transaction_date AS DATE), 'dd/MM/yyyy'), "
        "Transaction_date) ELSE Transaction_date END"
    )
    rows = dirty_transactions(spark, sf).withColumns({"transaction_date": day_first, "part": F.expr("CAST(seq % 3 AS INT)")})
    return formats.date_formats(rows, by=("part",))


# stored documents, views and snapshots


def metadata_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON documents that two ingestion runs left, as read back."""
    root, rows = scratch_folder(spark, "store"), dirty_transactions(spark, sf)
    for part in (0, 1):
        run_ingestion(spark, _as_csv(spark, rows.filter(F.col("seq") % 2 == part)), root)
    documents = spark.read.json(f"{root}/processed/ingestion_metadata")
    return documents.select(
        F.col("statistics.total_records").alias("total_records"),
        F.col("statistics.date_range.min").alias("min_date"),
        F.col("statistics.date_range.max").alias("max_date"),
        F.col("statistics.total_revenue").cast("decimal(28,2)").alias("total_revenue"),
        F.col("statistics.states_count").alias("states_count"),
    )


def stored_views(spark: SparkSession, sf: str) -> DataFrame:
    """The training view of a whole run's store, by its name."""
    open_store(spark, _whole_run(spark, sf))
    return spark.sql(
        "SELECT customer_segment, state_names, count(1) AS quarters, max(total_transactions) AS total_transactions, "
        "max(total_amount_spent) AS total_amount_spent FROM ml_training_features GROUP BY customer_segment, state_names"
    )


def stored_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots of two dates, the second one written twice, as read back."""
    root, features = scratch_folder(spark, "snapshots"), _customer(spark, sf)
    for day, rows in ((SNAPSHOT, features), (AS_OF, features.limit(0)), (AS_OF, features), (AS_OF, features)):
        write_snapshot(rows, root, "customer_features", day)
    kept = read_features(spark, root, "customer_features")
    return kept.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("total_amount_spent").cast("decimal(28,2)").alias("amount")
    )


def _arrived_late(spark: SparkSession, sf: str) -> str:
    """The dirty rows as a stream in which all later copies come before the first ones; the root of its store."""
    rows, folder, root = dirty_transactions(spark, sf), scratch_folder(spark, "csv"), scratch_folder(spark, "stream")
    median = cleaning.age_profile(cleaning.parse(rows)).first()["median_age"]
    for part, copies in (("b", "seq > 1000000000"), ("a", "seq <= 1000000000")):
        rows.where(copies).orderBy("seq").drop("seq").write.option("header", True).option("escape", '"').csv(f"{folder}/{part}")
        stream = read_csv_stream(spark, f"{folder}/*", files_per_trigger=4)
        start_exact_intake(stream, root, f"{root}/checkpoint", median).awaitTermination()
    return root


def stream_any_order(spark: SparkSession, sf: str) -> DataFrame:
    return _by_month(exact_transactions(spark, _arrived_late(spark, sf)))


def stream_median(spark: SparkSession, sf: str) -> DataFrame:
    """Ages sketched in seven batches and merged: how many there are, and whether the median's rank is within the sketch's bound."""
    parsed, root = cleaning.parse(dirty_transactions(spark, sf)), scratch_folder(spark, "stream")
    for number in range(7):
        add_ages(parsed.where(F.col("seq") % 7 == number), number, root)
    estimate = median_so_far(spark, root).select(F.struct("*")).scalar()
    median = estimate.getField("median_age")
    ranks = parsed.where("age IS NOT NULL").agg(F.count("age").alias("n"), F.count_if(F.col("age") < median).alias("below"), F.count_if(F.col("age") <= median).alias("upto"))
    return ranks.select(
        F.col("n").alias("ages"),
        (estimate.getField("known") == F.col("n")).alias("all_known"),
        ((F.col("below") <= (0.5 + RANK_ERROR) * F.col("n")) & (F.col("upto") >= (0.5 - RANK_ERROR) * F.col("n"))).alias("within_bounds"),
    )


def stream_deltas(spark: SparkSession, sf: str) -> DataFrame:
    return _result(exact_quarterly(spark, _arrived_late(spark, sf)))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        src_csv_roundtrip,
        scan_parquet,
        monthly_partition_counts,
        raw_transactions,
        raw_count,
        raw_inventory,
        clean_transactions,
        age_median_fill,
        amount_coerce,
        dedup_keep_first,
        dedup_report,
        filter_valid,
        quarantine_bad_dates,
        derive_calendar,
        cleaning_report,
        customer_features,
        quarterly_features,
        payment_features,
        state_features,
        top_segment_per_state,
        top_payment_per_state,
        ml_training_features,
        ml_training_latest,
        ml_training_features_alt,
        revenue_by_state,
        revenue_by_segment,
        top_customer_groups,
        store_counts,
        feature_snapshot,
        ingestion_stats,
        segment_histogram,
        payment_histogram,
        approx_customers,
        month_intake,
        run_all_features,
        csv_quoted_breaks,
        csv_quoted_records,
        rejected_after_two_runs,
        execution_log,
        recent_executions,
        run_report,
        gender_distribution,
        marital_distribution,
        payment_distribution,
        employment_distribution,
        distribution_maps,
        customer_cohorts,
        customer_retention,
        transaction_growth,
        payment_usage,
        dq_nulls,
        dq_freshness,
        dq_schema,
        dq_report,
        dq_feature_invariants,
        dq_unique,
        dq_not_null,
        dq_limits,
        stream_intake,
        stream_quarterly,
        ml_training_nested,
        sketched_customers,
        sketched_cohorts,
        bitmap_cohorts,
        exact_medians,
        frequent_customers,
        date_formats,
        metadata_documents,
        stored_views,
        stored_snapshots,
        stream_any_order,
        stream_deltas,
        stream_median,
    )
}
