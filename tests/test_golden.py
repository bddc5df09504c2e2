"""A small dirty CSV through intake and features, with results worked out by hand."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from spendgrain.operators import cleaning
from spendgrain.operators.features import (
    customer_features,
    payment_features,
    quarterly_features,
    state_features,
    top_value_per_state,
)
from spendgrain.sources.files import check_columns, csv_header, file_order, read_csv

HEADER = (
    "Transaction_date,Transaction_ID,Gender,Age,Marital_status,State_names,Segment,Employees_status,"
    "Payment_method,Referral,Amount_spent"
)
ROWS = """\
2018-01-05,T1,Female,30,Married,Ohio,Basic,Employees,Card,Yes,100.50
2018-01-06,T1,Male,30,Single,Ohio,Gold,Employees,Card,No,999.00
2018-01-20,T2,,,,,,,,,
2018-02-01,T3,Male,17,Single,Ohio,Basic,Employees,Card,No,10.00
2018-02-02,T4,Male,121,Single,Ohio,Basic,Employees,Card,No,10.00
2018-02-03,T5,Male,45,Single,Ohio,Basic,Employees,Card,No,-5.00
2018-02-04,T6,Male,51,Single,Ohio,Basic,Employees,PayPal,No,abc
2018-02-05,T7,Male,17,Single,Ohio,Basic,Employees,Card,No,20.00
2018-02-06,T7,Male,40,Single,Ohio,Basic,Employees,Card,No,20.00
2018-04-02,,Male,33,Single,Ohio,Basic,Employees,Other,Yes,200.00
2018-04-03,,Male,34,Single,Ohio,Basic,Employees,Other,Yes,300.00
2018-10-15,T8,Female,60,Married,Ohio,Basic,Employees,Card,No,50.25
not-a-date,T9,Female,28,Married,Utah,Gold,Employees,Card,No,75.00
2018-12-31,T10,Female,18,Married,Utah,Gold,Employees,Card,No,0.00
2019-01-01,T11,Female,120,Married,Utah,Gold,Employees,PayPal,No,40.00
"""


@pytest.fixture(scope="module")
def csv_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("golden") / "transactions.csv"
    path.write_text(HEADER + "\n" + ROWS)
    return str(path)


@pytest.fixture(scope="module")
def judged(spark, csv_file):
    scan = read_csv(spark, csv_file)
    return cleaning.clean(scan, file_order(scan)).cache()


@pytest.fixture(scope="module")
def good(judged):
    return cleaning.good(judged)


def test_profile_and_median(spark, csv_file):
    row = cleaning.age_profile(cleaning.parse(read_csv(spark, csv_file))).first()
    assert row["rows_in"] == 15
    assert row["median_age"] == 33
    assert (row["missing_age"], row["missing_transaction_id"], row["missing_transaction_date"]) == (1, 2, 1)
    assert row["missing_amount_value"] == 2


def test_accepted_rows(judged):
    rows = {r["transaction_id"]: r for r in cleaning.accepted(judged).collect()}
    assert set(rows) == {"T1", "T2", "T6", None, "T8", "T9", "T10", "T11"}
    t2 = rows["T2"]
    assert (t2["age"], t2["gender"], t2["segment"], t2["state_names"], t2["referral"]) == (
        33,
        "Unknown",
        "Regular",
        "Unknown",
        "No",
    )
    assert t2["amount_spent"] == 0 and rows["T6"]["amount_spent"] == 0
    assert rows["T1"]["gender"] == "Female"
    assert (rows[None]["age"], str(rows[None]["amount_spent"])) == (33, "200.00")
    assert rows["T9"]["transaction_date"] is None
    assert rows["T8"]["transaction_date"] == datetime(2018, 10, 15)


def test_quarantine_and_copies(spark, csv_file, judged):
    assert [(r["transaction_id"], r["reject_reason"]) for r in cleaning.quarantined(judged).collect()] == [
        ("T9", "bad_date")
    ]
    report = cleaning.copies_report(cleaning.parse(read_csv(spark, csv_file))).first()
    assert report["duplicates_removed"] == 3


def test_customer_features(good):
    rows = {
        (r["segment"], r["state_names"]): r
        for r in customer_features(good, as_of=datetime(2020, 1, 1)).collect()
    }
    ohio, utah, unknown = rows["Basic", "Ohio"], rows["Gold", "Utah"], rows["Regular", "Unknown"]
    assert len(rows) == 3
    # Four rows, but one has no id: counts skip it, sums and averages do not.
    assert (ohio["total_transactions"], str(ohio["total_amount_spent"])) == (3, "350.75")
    assert ohio["avg_transaction_amount"] == 87.6875
    assert round(ohio["std_transaction_amount"], 6) == 85.379392
    assert (ohio["days_active"], round(ohio["avg_days_between_transactions"], 6)) == (283, 94.333333)
    assert (ohio["avg_age"], ohio["referral_rate"]) == (43.5, 0.5)
    assert ohio["first_transaction_date"] == date(2018, 1, 5)
    assert (utah["total_transactions"], utah["days_active"], utah["avg_days_between_transactions"]) == (2, 1, 0.5)
    assert round(utah["std_transaction_amount"], 6) == 28.284271
    assert (unknown["std_transaction_amount"], unknown["avg_days_between_transactions"]) == (None, 0.0)
    assert (ohio["feature_version"], ohio["created_at"]) == ("v1", datetime(2020, 1, 1))


def test_quarterly_features(good):
    found = {
        (r["year"], r["quarter"], r["segment"], r["state_names"]): (
            r["quarterly_transactions"],
            str(r["quarterly_revenue"]),
            None if r["revenue_growth_rate"] is None else round(r["revenue_growth_rate"], 5),
        )
        for r in quarterly_features(good).collect()
    }
    assert found == {
        (2018, 1, "Basic", "Ohio"): (2, "100.50", 0.0),
        (2018, 2, "Basic", "Ohio"): (0, "200.00", 0.99005),
        (2018, 4, "Basic", "Ohio"): (1, "50.25", -0.74875),
        (2018, 4, "Gold", "Utah"): (1, "0.00", 0.0),
        (2019, 1, "Gold", "Utah"): (1, "40.00", None),
        (2018, 1, "Regular", "Unknown"): (1, "0.00", 0.0),
    }


def test_payment_features(good):
    shares = {
        (r["payment_method"], r["segment"]): round(r["usage_percentage"], 6)
        for r in payment_features(good).collect()
    }
    assert shares == {
        ("Card", "Basic"): 0.285714,
        ("Card", "Gold"): 0.142857,
        ("Other", "Basic"): 0.0,
        ("PayPal", "Basic"): 0.142857,
        ("PayPal", "Gold"): 0.142857,
        ("Unknown", "Regular"): 0.142857,
    }


def test_state_features(good):
    rows = {r["state_names"]: r for r in state_features(good).collect()}
    assert (rows["Ohio"]["total_customers"], round(rows["Ohio"]["avg_customer_value"], 6)) == (3, 116.916667)
    assert (rows["Utah"]["total_customers"], rows["Utah"]["avg_customer_value"]) == (2, 20.0)
    assert (rows["Ohio"]["top_segment"], rows["Ohio"]["top_payment_method"]) == ("Basic", "Card")
    # Card and PayPal are level in Utah: the alphabetically first wins.
    assert rows["Utah"]["top_payment_method"] == "Card"
    tops = top_value_per_state(good, "payment_method", "payment_count", "top").collect()
    assert {r["state_names"]: r["top"] for r in tops} == {"Ohio": "Card", "Utah": "Card", "Unknown": "Unknown"}


def test_no_state_has_no_top_value(spark, good):
    nameless = good.withColumn("state_names", F.lit(None).cast("string"))
    row = state_features(nameless).first()
    assert (row["state_names"], row["total_customers"], row["top_segment"]) == (None, 6, None)


def test_header_checks(spark, csv_file, tmp_path):
    assert check_columns(csv_header(spark, csv_file))
    with pytest.raises(ValueError, match="Transaction_ID"):
        check_columns(HEADER.replace("Transaction_ID", "transaction_id").split(","))
    with pytest.raises(FileNotFoundError):
        csv_header(spark, str(tmp_path / "absent.csv"))


NUMBERS = {
    "12": 12.0,
    " 12.50 ": 12.5,
    "+.5": 0.5,
    "5.": 5.0,
    "1e3": 1000.0,
    "1E-2": 0.01,
    "inf": float("inf"),
    "-Infinity": float("-inf"),
    "1.5f": None,
    "12D": None,
    "0x10": None,
    "0x1p3": None,
    "1,000": None,
    "NaN": None,
    "": None,
    "abc": None,
    "--1": None,
    "9" * 60: 1e60,
}


def test_number_texts(spark):
    from spendgrain.functions.parsing import amount_sql, money_sql, number_sql

    df = spark.createDataFrame([(k,) for k in NUMBERS], "t string")
    found = {r["t"]: r for r in df.selectExpr("t", f"{number_sql('t')} n", f"{money_sql('t')} m", f"{amount_sql('t')} a").collect()}
    for text, number in NUMBERS.items():
        assert found[text]["n"] == number, text
        assert found[text]["a"] == number, text
    assert str(found[" 12.50 "]["m"]) == "12.50" and found["inf"]["m"] is None and found["9" * 60]["m"] is None


DATES = {"2018-01-05": True, "2018-1-5": False, "2018-13-05": False, "2018": False, " 2018-01-05": False, "x": False}


def test_date_texts(spark):
    from spendgrain.functions.parsing import timestamp_ntz_sql

    df = spark.createDataFrame([(k,) for k in DATES], "t string")
    rows = df.selectExpr("t", f"{timestamp_ntz_sql('t', 'yyyy-MM-dd')} d").collect()
    assert {r["t"]: r["d"] is not None for r in rows} == DATES
    other = spark.createDataFrame([("05/01/2018",), ("2018-01-05",)], "t string")
    found = [r["d"] for r in other.selectExpr(f"{timestamp_ntz_sql('t', 'dd/MM/yyyy')} d").collect()]
    assert found == [datetime(2018, 1, 5), None]
    timed = spark.createDataFrame([("2018-01-05 13:45:00",)], "t string")
    found = timed.selectExpr(f"{timestamp_ntz_sql('t', 'yyyy-MM-dd HH:mm:ss')} d").first()["d"]
    assert found == datetime(2018, 1, 5, 13, 45)
    quoted = spark.createDataFrame([("2018-01-05T13:45",)], "t string")
    found = quoted.selectExpr(f"{timestamp_ntz_sql('t', "yyyy-MM-dd'T'HH:mm")} d").first()["d"]
    assert found == datetime(2018, 1, 5, 13, 45)


def raw_rows(spark, rows):
    """(id, age, amount) with everything else fixed, in list order."""
    data = [(f"2018-01-{1 + i % 28:02d}", t, "F", a, "M", "Ohio", "Basic", "E", "Card", "No", m, i) for i, (t, a, m) in enumerate(rows)]
    return spark.createDataFrame(data, schema=", ".join(f"{c} string" for c in HEADER.split(",")) + ", seq int")


def test_amount_edges(spark):
    amounts = {"a": "-0.001", "b": "-0", "c": "inf", "d": "99999999999999999.99", "e": "0.005", "f": "-inf"}
    df = raw_rows(spark, [(k, "30", v) for k, v in amounts.items()])
    found = {r["transaction_id"]: (r["reject_reason"], str(r["amount_spent"])) for r in cleaning.clean(df, ["seq"]).collect()}
    assert found == {
        "a": ("negative_amount", "0.00"),
        "b": (None, "0.00"),
        "c": ("amount_out_of_range", "None"),
        "d": ("amount_out_of_range", "None"),
        "e": (None, "0.01"),
        "f": ("negative_amount", "None"),
    }


@pytest.mark.parametrize(
    ("ages", "median"),
    [
        (["20.5"], 20),
        (["30", "31"], 30),
        (["30", "33", None], 31),
        (["30.2", "30.9", "31", "29"], 30),
        (["18", "40", "41.5", "2000000"], 40),
        (["17.9", "18.1"], 18),
        (["5000", "6000", "7000"], 6000),
        (["-2000", "-3000"], -2500),
        (["10", "5000"], 2505),
        (["5000", "5000", "6000"], 5000),
        (["1e300", "2e300"], 2**31 - 1),
        (["-1.5", "0.5"], 0),
        ([None], None),
        ([], None),
    ],
)
def test_median_age(spark, ages, median):
    df = raw_rows(spark, [(str(i), a, "1") for i, a in enumerate(ages)])
    assert cleaning.age_profile(cleaning.parse(df)).first()["median_age"] == median


def test_median_age_against_exact(spark):
    import random
    import statistics

    rng = random.Random(5)
    for n in (7, 8, 50, 51):
        ages = [round(rng.uniform(0, 130), rng.choice([0, 1, 2])) for _ in range(n)]
        df = raw_rows(spark, [(str(i), str(a), "1") for i, a in enumerate(ages)])
        assert cleaning.age_profile(cleaning.parse(df)).first()["median_age"] == int(statistics.median(ages))


def test_no_age_at_all_fails(spark):
    df = raw_rows(spark, [("a", None, "1"), ("b", "x", "1")])
    with pytest.raises(Exception, match="no median"):
        cleaning.clean(df, ["seq"]).collect()


def test_missing_tokens(spark):
    from spendgrain.schema import NA_TOKENS

    values = [*NA_TOKENS, " n/a", "Missing", "none"]
    df = raw_rows(spark, [(str(i), "30", "1") for i in range(len(values))])
    lookup = F.create_map(*[F.lit(x) for i, v in enumerate(values) for x in (str(i), v)])
    filled = cleaning.clean(df.withColumn("Segment", lookup[F.col("Transaction_ID")]), ["seq"])
    found = {values[int(r["transaction_id"])]: r["segment"] for r in filled.collect()}
    assert all(found[t] == "Regular" for t in NA_TOKENS)
    assert (found[" n/a"], found["Missing"], found["none"]) == (" n/a", "Missing", "none")


def test_keys_tell_nulls_and_separators_apart(spark):
    from spendgrain.functions.keys import stable_key

    rows = [(None, "X"), ("X", None), ("a|b", "c"), ("a", "b|c"), ("1:a", ""), ("", "1:a"), (None, None), ("N", None)]
    keyed = spark.createDataFrame(rows, "a string, b string").select(stable_key("a", "b").alias("key"))
    assert keyed.distinct().count() == len(rows)


def test_deviation_of_amounts_at_the_limit(spark):
    from spendgrain.functions.measures import MEASURES, SAMPLE_STDDEV

    amounts = [("t", "9999999999999999.99" if i % 2 else "-9999999999999999.99") for i in range(400)]
    rows = spark.createDataFrame(amounts, "transaction_id string, amount string").selectExpr(
        "transaction_id", "CAST(amount AS DECIMAL(18,2)) AS amount_spent", "monotonically_increasing_id() % 2 AS part"
    )
    names = [n for n in MEASURES if n.startswith("amount_")]
    parts = rows.groupBy("part").agg(*[F.expr(MEASURES[n][0]).alias(n) for n in names])
    merged = parts.agg(*[F.expr(MEASURES[n][1]).alias(n) for n in names])
    assert merged.selectExpr(f"{SAMPLE_STDDEV} AS s").first()["s"] == pytest.approx(1e16, rel=0.01)
