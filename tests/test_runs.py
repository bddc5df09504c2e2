"""Whole runs, sinks and run records."""

import json
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, functions as F

from spendgrain.operators import features as fs
from spendgrain.operators import quality, views
from spendgrain.operators.cohorts import cohort_counts, customer_moves, full_quarterly
from spendgrain.functions.calendar import with_quarters
from spendgrain.functions.measures import measures
from spendgrain.operators.distributions import DISTRIBUTIONS, distribution
from spendgrain.plans.ingestion import run_ingestion
from spendgrain.plans.refresh import open_store, run_all, run_features
from spendgrain.schema import STORE_KEYS, STORE_TABLES, conform
from spendgrain.sources import store
from spendgrain.sources.files import inventory, read_month_files, read_raw, read_stored
from tests.test_golden import HEADER, ROWS

AS_OF = datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    csv = folder / "transactions.csv"
    csv.write_text(HEADER + "\n" + ROWS)
    result = run_all(spark, str(csv), str(folder / "store"), AS_OF, snapshot_date=date(2020, 1, 2))
    return str(csv), str(folder / "store"), result


def test_ingestion_document(run):
    _, root, result = run
    document = result["ingestion"]
    assert (document["rows_in"], document["duplicates_removed"], document["median_age"]) == (15, 3, 33)
    assert document["rejected"] == {
        "bad_record": 0,
        "age_out_of_range": 3,
        "negative_amount": 1,
        "bad_date": 1,
        "amount_out_of_range": 0,
    }
    stats = document["statistics"]
    assert (stats["total_records"], stats["unique_customers"], stats["states_count"]) == (7, 7, 3)
    assert stats["date_range"] == {"min": "2018-01-05", "max": "2019-01-01"}
    assert str(stats["total_revenue"]) == "390.75"
    assert stats["segments"] == {"Basic": 4, "Gold": 2, "Regular": 1}
    assert stats["payment_methods"] == {"Card": 3, "Other": 1, "PayPal": 2, "Unknown": 1}
    assert document["files_created"] == 6
    (written,) = Path(root, "processed", "ingestion_metadata").glob("*/*.json")
    stored = json.loads(written.read_text())
    assert stored["statistics"]["total_records"] == 7 and stored["files_created"] == 6
    assert stored["statistics"]["segments"] == stats["segments"]


def test_monthly_layout(spark, run):
    _, root, _ = run
    raw = read_raw(spark, f"{root}/raw")
    months = {(r["year"], r["month"], r["year_month"]) for r in raw.collect()}
    assert months == {
        (2018, 1, "2018-01"),
        (2018, 2, "2018-02"),
        (2018, 4, "2018-04"),
        (2018, 10, "2018-10"),
        (2018, 12, "2018-12"),
        (2019, 1, "2019-01"),
    }
    types = dict(raw.dtypes)
    assert types["transaction_date"] == "timestamp_ntz" and types["amount_spent"] == "decimal(18,2)"
    assert read_stored(spark, f"{root}/raw").filter("reject_reason is not null").count() == 5


def test_feature_tables_match_direct_computation(spark, run):
    _, root, result = run
    assert (result["features"]["status"], result["features"]["records_processed"]) == ("success", 7)
    raw = read_raw(spark, f"{root}/raw")
    direct = {
        "customer_features": fs.customer_features(raw, AS_OF),
        "payment_features": fs.payment_features(raw, AS_OF),
        "state_features": fs.state_features(raw, AS_OF),
        "quarterly_features": full_quarterly(
            measures(with_quarters(raw), *fs.QUARTER_KEYS),
            cohort_counts(customer_moves(raw)),
            AS_OF,
        ),
    }
    for name, expected in direct.items():
        found = store.read_features(spark, f"{root}/features", name).select(*expected.columns)
        assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0, name


def test_distribution_maps(spark, run):
    _, root, _ = run
    raw = read_raw(spark, f"{root}/raw")
    table = store.read_features(spark, f"{root}/features", "customer_features")
    for dimension, name in DISTRIBUTIONS.items():
        long = distribution(raw, dimension).collect()
        expected = {}
        for r in long:
            expected.setdefault((r["segment"], r["state_names"]), {})[r["value"]] = r["transactions"]
        assert {(r["segment"], r["state_names"]): r[name] for r in table.collect()} == expected


def test_rerun_gives_the_same(spark, run):
    csv, root, result = run
    before = read_raw(spark, f"{root}/raw").drop("batch_id").collect()
    again = run_ingestion(spark, csv, root, AS_OF)
    assert again["statistics"] == result["ingestion"]["statistics"]
    assert sorted(map(str, read_raw(spark, f"{root}/raw").collect())) == sorted(map(str, before))


def test_untouched_months_stay(spark, run, tmp_path):
    _, root, _ = run
    extra = tmp_path / "more.csv"
    extra.write_text(HEADER + "\n2018-01-30,N1,Male,40,Single,Iowa,Gold,Employees,Card,No,5.00\n")
    target = str(tmp_path / "store")
    csv = tmp_path / "first.csv"
    csv.write_text(HEADER + "\n" + ROWS)
    run_ingestion(spark, str(csv), target, AS_OF)
    second = run_ingestion(spark, str(extra), target, AS_OF)
    assert second["files_created"] == 1 and second["statistics"]["total_records"] == 1
    by_month = {r["year_month"]: r["n"] for r in read_raw(spark, f"{target}/raw").groupBy("year_month").agg(F.count("*").alias("n")).collect()}
    # January 2018 is replaced, the others are as they were.
    assert by_month == {"2018-01": 1, "2018-02": 1, "2018-04": 1, "2018-10": 1, "2018-12": 1, "2019-01": 1}
    # Two runs wrote the table now, so the feature run counts distinct ids the long way.
    run_features(spark, target, AS_OF)
    state = store.read_features(spark, f"{target}/features", "state_features")
    assert {r["state_names"]: r["total_customers"] for r in state.collect()} == {"Iowa": 1, "Ohio": 2, "Utah": 2}


def test_execution_log(spark, run):
    _, root, _ = run
    log = store.read_log(spark, root)
    assert log.schema == STORE_TABLES["pipeline_execution_log"]
    rows = {r["pipeline_name"]: r for r in log.collect()}
    ingest = rows["monthly_data_ingestion"]
    assert (ingest["status"], ingest["records_processed"], ingest["records_inserted"], ingest["records_failed"]) == (
        "completed",
        15,
        7,
        5,
    )
    assert ingest["metadata"]["source_file"].endswith("transactions.csv")
    newest = views.recent_executions(log, 1).collect()
    assert len(newest) == 1 and newest[0]["execution_date"] == max(r["execution_date"] for r in log.collect())


def test_failed_run_is_logged(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_ingestion(spark, str(tmp_path / "absent.csv"), str(tmp_path))
    row = store.read_log(spark, str(tmp_path)).first()
    assert (row["status"], row["records_processed"]) == ("failed", 0) and "absent.csv" in row["error_message"]


def test_log_rows_take_maps_and_check_status(spark):
    now = datetime(2020, 1, 1)
    entry = store.log_entry("database_initialization", "completed", 0, now, now, metadata={"message": "created"})
    df = store.log_rows(spark, [entry, entry])
    assert df.schema == STORE_TABLES["pipeline_execution_log"]
    assert df.first()["metadata"] == {"message": "created"}
    assert json.loads(store.jdbc_ready(df).first()["metadata"]) == {"message": "created"}
    with pytest.raises(ValueError, match="unknown status"):
        store.log_entry("x", "done", 0, now, now)


def test_snapshot_replaces_its_date_only(spark, run, tmp_path):
    _, root, _ = run
    assert spark.read.parquet(f"{root}/snapshots/state_features").select("snapshot_date").distinct().first()[0] == date(2020, 1, 2)
    df = spark.createDataFrame([(1,), (2,)], "n int")
    path = str(tmp_path)
    store.write_snapshot(df, path, "t", date(2020, 1, 1))
    store.write_snapshot(df, path, "t", date(2020, 1, 2))
    store.write_snapshot(df.limit(1), path, "t", date(2020, 1, 2))
    found = spark.read.parquet(f"{path}/t").groupBy("snapshot_date").count().collect()
    assert {r["snapshot_date"]: r["count"] for r in found} == {date(2020, 1, 1): 2, date(2020, 1, 2): 1}


def test_conformed_store_tables(spark, run):
    _, root, _ = run
    for name in STORE_KEYS:
        df = conform(store.read_features(spark, f"{root}/features", name), name)
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in STORE_TABLES[name]]
        key = df.columns[0]
        assert df.select(key).distinct().count() == df.count()
    row = conform(store.read_features(spark, f"{root}/features", "customer_features"), "customer_features").filter("state_names = 'Ohio'").first()
    assert (str(row["avg_transaction_amount"]), str(row["std_transaction_amount"]), str(row["referral_rate"])) == ("87.69", "85.38", "0.5000")


def test_jdbc_sink_passes_a_flat_table(spark, run, monkeypatch):
    """No database is started: the last step, Spark's own writer, is replaced."""
    _, root, _ = run
    calls = []

    class Writer:
        def __init__(self, df):
            self.df = df

        def jdbc(self, url, table, mode, properties):
            calls.append((url, table, mode, properties, dict(self.df.dtypes), self.df.rdd.getNumPartitions()))

    monkeypatch.setattr(type(spark.range(1)), "write", property(Writer))
    df = conform(store.read_features(spark, f"{root}/features", "customer_features"), "customer_features")
    monkeypatch.setenv("POSTGRES_HOST", "db")
    monkeypatch.setenv("POSTGRES_PASSWORD", "secret")
    store.write_jdbc(df, "customer_features", "overwrite", connections=2)
    ((url, table, mode, properties, types, partitions),) = calls
    assert (url, table, mode) == ("jdbc:postgresql://db:5432/feature_store", "customer_features", "overwrite")
    assert properties["password"] == "secret" and properties["driver"] == "org.postgresql.Driver"
    assert types["gender_distribution"] == "string" and partitions <= 2


def test_store_by_name(spark, run):
    """The queries a user of the store types."""
    _, root, _ = run
    open_store(spark, root)

    def rows(query):
        return [tuple(r) for r in spark.sql(query).collect()]

    by_segment = "SELECT customer_segment, SUM(total_amount_spent) AS revenue FROM customer_features GROUP BY customer_segment"
    assert {k: str(v) for k, v in rows(by_segment)} == {"Basic": "350.75", "Gold": "40.00", "Regular": "0.00"}
    assert {k: str(v) for k, v in rows("SELECT state_names, total_revenue FROM state_features")} == {
        "Ohio": "350.75",
        "Unknown": "0.00",
        "Utah": "40.00",
    }
    assert rows("SELECT COUNT(*) FROM raw_transactions") == [(7,)]
    assert len(rows("SELECT * FROM pipeline_execution_log ORDER BY execution_date DESC LIMIT 10")) >= 2
    # One training row per group and quarter, in 14 columns.
    training = rows("SELECT * FROM ml_training_features LIMIT 10")
    assert len(training) == 6 and len(training[0]) == 14
    counts = rows(
        "SELECT 'customer_features' AS table_name, COUNT(*) AS record_count FROM customer_features "
        "UNION ALL SELECT 'quarterly_features', COUNT(*) FROM quarterly_features "
        "UNION ALL SELECT 'payment_features', COUNT(*) FROM payment_features "
        "UNION ALL SELECT 'state_features', COUNT(*) FROM state_features ORDER BY table_name"
    )
    assert counts == [("customer_features", 3), ("payment_features", 6), ("quarterly_features", 6), ("state_features", 3)]


def test_referral_words(spark, run, tmp_path):
    _, root, _ = run
    raw = read_raw(spark, f"{root}/raw").withColumn("referral", F.expr("CASE referral WHEN 'Yes' THEN '1.0' ELSE '0.0' END"))
    rates = {r["state_names"]: r["referral_rate"] for r in fs.customer_features(raw, referral_yes=("Yes", "1.0")).collect()}
    assert rates == {"Ohio": 0.5, "Utah": 0.0, "Unknown": 0.0}
    assert max(r["referral_rate"] for r in fs.customer_features(raw).collect()) == 0.0


def test_month_files_from_elsewhere(spark, tmp_path):
    """Year folders with one Parquet file per month, float amounts and a counted month period."""
    rows = [(datetime(2018, 1, 5), "T1", 30, 10.5, 576), (datetime(2018, 2, 5), "T2", 31, 0.1, 577)]
    for r in rows:
        df = spark.createDataFrame([r], "transaction_date timestamp_ntz, transaction_id string, age bigint, amount_spent double, year_month bigint")
        df.coalesce(1).write.parquet(str(tmp_path / "2018" / f"transactions_2018_{r[0].month:02d}.parquet"))
    df = read_month_files(spark, str(tmp_path / "*" / "*.parquet"))
    found = {r["transaction_id"]: (r["age"], str(r["amount_spent"]), r["year_month"]) for r in df.collect()}
    assert found == {"T1": (30, "10.50", "2018-01"), "T2": (31, "0.10", "2018-02")}


def test_file_checks(spark, run):
    _, root, _ = run
    scan = spark.read.parquet(f"{root}/raw")
    now = datetime.now()
    fresh = quality.file_freshness(scan, now).first()["recent_files"]
    assert fresh == len(scan.inputFiles())
    assert quality.file_freshness(scan, now + timedelta(days=30)).first()["recent_files"] == 0
    dated = inventory(scan.drop("year", "month", "year_month").filter("transaction_date is not null"))
    assert {(r["year"], r["month"]) for r in dated.collect()} >= {(2018, 1), (2019, 1)}


def test_schema_differences(spark):
    from spendgrain.schema import CLEAN_SCHEMA

    df = spark.createDataFrame([], CLEAN_SCHEMA)
    assert quality.schema_differences(df, CLEAN_SCHEMA) == []
    changed = df.withColumn("age", F.col("age").cast("long")).drop("referral").withColumn("Extra", F.lit(1))
    assert quality.schema_differences(changed, CLEAN_SCHEMA) == [
        ("Extra", None, "int"),
        ("age", "int", "bigint"),
        ("referral", "string", None),
    ]


def test_limits_flag_wide_values(spark):
    row = {"transaction_id": "x" * 51, "gender": "g", "marital_status": "m", "state_names": "s", "segment": "s", "employees_status": "e", "payment_method": "p", "referral": "y"}
    df = spark.createDataFrame([row]).withColumn("amount_spent", F.lit("123456789.00").cast("decimal(18,2)"))
    found = {r["column_name"]: (r["violations"], r["widest"]) for r in quality.limit_check(df).collect()}
    assert found["transaction_id"] == (1, 51) and found["amount_spent"] == (1, 9) and found["gender"] == (0, 1)


def test_operators_return_dataframes(spark, run):
    _, root, _ = run
    raw = read_raw(spark, f"{root}/raw")
    assert isinstance(raw.transform(fs.customer_features), DataFrame)


def test_two_runs_keep_what_each_rejected(spark, tmp_path):
    target = str(tmp_path / "store")
    for name, month in (("a", "01"), ("b", "02")):
        lines = [f"2018-{month}-05,{name}1,Male,40,Single,Iowa,Gold,Employees,Card,No,5.00"]
        lines += [f"2018-{month}-05,{name}2,Male,17,Single,Iowa,Gold,Employees,Card,No,5.00"]
        lines += [f'2018-{month}-05,{name}3,Male,40,Single,"New', 'York",Gold,Employees,Card,No,7.00']
        (tmp_path / f"{name}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
        found = run_ingestion(spark, str(tmp_path / f"{name}.csv"), target, AS_OF)
        assert (found["rows_in"], found["duplicates_removed"], found["files_created"]) == (4, 0, 1)
        assert found["rejected"]["bad_record"] == 2 and found["rejected"]["age_out_of_range"] == 1
    assert {r["transaction_id"] for r in read_raw(spark, f"{target}/raw").collect()} == {"a1", "b1"}
    rejected = read_stored(spark, f"{target}/raw").filter("reject_reason is not null").collect()
    assert sorted(r["reject_reason"] for r in rejected) == ["age_out_of_range"] * 2 + ["bad_record"] * 4
    assert 'York",Gold,Employees,Card,No,7.00' in {r["bad_record"] for r in rejected}


def test_reader_options_and_date_format_go_through(spark, tmp_path):
    line = '05/01/2018,a1,Male,40,Single,"New\nYork",Gold,Employees,Card,No,5.00'
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{line}\n")
    target = str(tmp_path / "store")
    run_all(spark, str(tmp_path / "a.csv"), target, AS_OF, date_format="dd/MM/yyyy", csv_options={"multiLine": "true"})
    (row,) = read_raw(spark, f"{target}/raw").collect()
    assert (row["state_names"], row["year_month"]) == ("New\nYork", "2018-01")


def test_features_over_month_files_written_elsewhere(spark, run, tmp_path):
    _, root, _ = run
    raw = read_raw(spark, f"{root}/raw").drop("year", "month", "year_month")
    raw.withColumn("amount_spent", F.col("amount_spent").cast("double")).coalesce(1).write.parquet(str(tmp_path / "raw" / "2018"))
    run_features(spark, str(tmp_path / "store"), AS_OF, month_files=str(tmp_path / "raw" / "*" / "*.parquet"))
    found = store.read_features(spark, str(tmp_path / "store" / "features"), "state_features")
    expected = store.read_features(spark, f"{root}/features", "state_features")
    assert sorted(map(str, found.drop("created_at").collect())) == sorted(map(str, expected.drop("created_at").collect()))
