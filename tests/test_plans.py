"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from spendgrain.catalog.queries import QUERIES
from spendgrain.operators import cleaning
from spendgrain.operators import features as fs
from spendgrain.operators.cohorts import customer_moves
from spendgrain.sources.files import read_csv, write_monthly
from spendgrain.sources.testdata import dirty_transactions, transactions

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stream_intake", "stream_quarterly"}))
def test_no_python_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not any(node in text for node in PYTHON_NODES)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_only_needed_columns_are_read(spark):
    text = plan(fs.payment_features(transactions(spark, SF)))
    (schema,) = set(re.findall(r"ReadSchema: (struct<o_[^>]*>)", text)) - {"struct<o_custkey:bigint>"}
    assert schema == "struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderpriority:string>"


def test_copies_are_dropped_before_the_shuffle(spark):
    text = plan(cleaning.keep_first(cleaning.standard_names(dirty_transactions(spark, SF)), ["seq"]))
    before, after = text.index("Final"), text.index("Partial")
    assert "WindowGroupLimit" in text and "Exchange" in text[before:after]


def test_age_and_amount_rules_stay_above_the_copy_filter(spark):
    text = plan(cleaning.accepted(cleaning.clean(dirty_transactions(spark, SF), ["seq"], median_age=40)))
    assert text.index("age_out_of_range") < text.index("WindowGroupLimit")


def test_top_value_keeps_one_row_per_state_before_the_shuffle(spark):
    text = plan(fs.top_value_per_state(transactions(spark, SF), "segment", "n", "top"))
    assert "WindowGroupLimit" in text


def test_unique_ids_are_not_shuffled(spark):
    text = plan(fs.state_features(transactions(spark, SF), ids_unique=True))
    assert not re.search(r"hashpartitioning\([^)]*transaction_id", text)
    assert text.count("o_custkey") and "distinct" not in text


def test_customers_are_reduced_before_they_meet(spark):
    text = plan(customer_moves(transactions(spark, SF), "customer_key"))
    # Below the window over a customer's quarters: the distinct, on both sides of its shuffle.
    below = text[text.index("+- Window") :]
    assert below.count("HashAggregate(keys=[segment") == 2
    assert below.index("HashAggregate") < below.index("hashpartitioning(segment", below.index("HashAggregate"))


def test_csv_median_pass_reads_one_column(spark, tmp_path):
    dirty_transactions(spark, SF).drop("seq").write.option("header", True).csv(str(tmp_path / "csv"))
    scan = read_csv(spark, str(tmp_path / "csv"))
    text = plan(cleaning.age_profile(cleaning.parse(scan)).select("rows_in", "median_age"))
    assert re.findall(r"ReadSchema: (struct<[^>]*>)", text) == ["struct<Age:string,bad_record:string>"]


@pytest.mark.parametrize(("name", "most"), [("cleaning_report", 2), ("dq_report", 2)])
def test_reports_read_their_orders_twice(spark, name, most):
    report = QUERIES[name](spark, SF)
    report.collect()
    # A subquery that ran once is printed wherever it is used, with the same columns.
    scans = set(re.findall(r"FileScan parquet (\[[^\]]*\bo_[^\]]*)", plan(report)))
    assert 0 < len(scans) <= most


def test_a_hot_month_is_split_over_files(spark, tmp_path):
    rows = spark.range(200_000).select(
        F.lit("2018-01-05").cast("timestamp_ntz").alias("transaction_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(1 << 20))
    try:
        write_monthly(rows.repartition(8), str(tmp_path / "raw"))
    finally:
        spark.conf.set(key, before)
    files = list((tmp_path / "raw" / "year=2018" / "month=1").glob("*/*.parquet"))
    assert len(files) > 4


def test_touched_quarters_read_their_folders_only(spark, tmp_path):
    rows = spark.range(1000).selectExpr(
        "CAST(date_add(DATE'2018-01-01', CAST(id AS INT)) AS TIMESTAMP_NTZ) AS transaction_date", "CAST(id AS STRING) AS transaction_id"
    )
    write_monthly(rows, str(tmp_path / "raw"))
    from spendgrain.sources.files import read_raw
    from spendgrain.streaming.intake import rows_of_quarters

    batch = rows.filter("transaction_date = TIMESTAMP_NTZ'2018-05-05 00:00:00'")
    touched = rows_of_quarters(read_raw(spark, str(tmp_path / "raw")), batch)
    assert touched.count() == 91
    assert "dynamicpruning" in plan(touched).lower()
