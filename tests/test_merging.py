"""Sketches, bitmaps, selection, frequent values, date formats and the nested view, on small and odd inputs."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from spendgrain.catalog import queries
from spendgrain.operators import formats, frequent, selection, sketches, views
from spendgrain.operators.cohorts import cohort_counts, customer_moves
from spendgrain.plans.ingestion import run_ingestion
from tests.test_golden import HEADER

SF = "/root/testdata/sf0.001"
MOVES = ["year", "quarter", "segment", "state_names", "unique_customers", "new_customers", "returning_customers", "retained_customers"]


def rows(frame, columns):
    return sorted(tuple(str(x[c]) for c in columns) for x in frame.select(*columns).collect())


def activity(spark, n=3000, customers=400, seed=1):
    """Customers in quarters with gaps, unknown customers and groups without a state."""
    r = random.Random(seed)
    data = [
        (r.choice(["A", "B", None]), r.choice(["Ohio", "Utah", None]), f"20{r.randint(17, 19)}-{r.choice([2, 5, 11]):02d}-03", r.choice([None, *[r.randint(0, customers)] * 9]))
        for _ in range(n)
    ]
    data += [("C", "Ohio", "2018-02-03", None), ("C", "Ohio", "2019-02-03", 70_000), ("C", "Ohio", "2019-05-03", 70_000)]
    return spark.createDataFrame(data, "segment string, state_names string, transaction_date string, customer long").withColumn("transaction_date", F.to_date("transaction_date"))


def test_bitmaps_and_sketches_give_the_exact_cohorts(spark):
    df = activity(spark)
    wanted = rows(cohort_counts(customer_moves(df, "customer")), MOVES)
    assert rows(sketches.bitmap_cohorts(sketches.customer_bitmaps(df, "customer")), MOVES) == wanted
    # Few customers: the sketches hold them all.
    assert rows(sketches.sketch_cohorts(sketches.customer_sketches(df, "customer")), MOVES) == wanted
    assert sketches.bitmap_cohorts(sketches.customer_bitmaps(df.limit(0), "customer")).count() == 0


def test_sketches_of_many_customers_are_within_their_bounds(spark):
    df = activity(spark, n=60_000, customers=100_000)
    exact = cohort_counts(customer_moves(df, "customer"))
    small = sketches.sketch_cohorts(sketches.customer_sketches(df, "customer", bits=9), bits=9)
    checked = sketches.checked_cohorts(small, exact)
    assert checked.where("NOT within_bounds").count() <= 1 and checked.count() == exact.count()
    assert small.where("bound > 0").count() > 20
    whole = sketches.distinct_customers(sketches.customer_sketches(df, "customer")).first()
    n = df.select("customer").where("customer IS NOT NULL").distinct().count()
    assert abs(whole["customers_estimate"] - n) <= whole["bound"] < 0.06 * n


@pytest.mark.parametrize("values", [[5.0], [1, 2], [2, 2, 2, 9], [1e308, -1e308, 0, 3], [0.1 * i for i in range(999)], [5e-324, 0.0, 1e-323], [7.5, None, float("nan")], [None]])
def test_selection_of_small_lists(spark, values):
    df = spark.createDataFrame([(v if v is None else float(v),) for v in values], "v double")
    known = [v for v in values if v is not None and v == v]
    n, median = selection.exact_median(df, "v", buckets=4)
    assert n == len(known) and median == (statistics.median(known) if known else None)


def test_selection_of_many_distinct_values(spark):
    df = spark.range(1_000_001).select((F.col("id") * 7919 % 1_000_003 + F.rand(1) / 2).alias("v"))
    n, median = selection.exact_median(df, "v", buckets=256)
    wanted = sorted(x["v"] for x in df.where("v BETWEEN 450000 AND 550000").collect())
    below = df.where("v < 450000").count()
    assert n == 1_000_001 and median == wanted[n // 2 - below]


def test_frequent_values_against_counts(spark):
    r = random.Random(4)
    data = [r.choice(["hot"] * 3 + ["warm", f"rare {r.randint(0, 10**6)}", None]) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in data], "v string").repartition(6)
    given = [v for v in data if v is not None]
    often = {v: given.count(v) for v in ("hot", "warm")}
    found = {x["value"]: (x["row_count"], x["other"]) for x in frequent.frequent_values(df, "v", share=0.01).collect()}
    assert found == {v: (n, False) for v, n in often.items()} | {None: (len(given) - sum(often.values()), True)}
    assert [tuple(x) for x in frequent.frequent_values(df.where("v = 'hot'"), "v").collect()] == [("hot", often["hot"], False)]
    assert frequent.frequent_values(df.where("v IS NULL"), "v").count() == 0


def test_date_formats(spark, tmp_path):
    dates = ["2018-01-05", "05/01/2018", "05/01/2018", "13/01/2018", "x", None]
    found = formats.date_formats(spark.createDataFrame([(d,) for d in dates], "transaction_date string")).collect()
    readable = {x["date_format"]: (x["readable"], x["chosen"], x["tied"]) for x in found}
    assert readable["dd/MM/yyyy"] == (3, True, False) and readable["MM/dd/yyyy"] == (2, False, False) and readable["yyyy-MM-dd"] == (1, False, False)
    assert {x["given"] for x in found} == {5}
    tie = formats.date_formats(spark.createDataFrame([("05/01/2018",)], "transaction_date string")).where("chosen").first()
    assert (tie["date_format"], tie["tied"]) == ("dd/MM/yyyy", True)
    assert formats.best_format(spark.createDataFrame([("x",)], "transaction_date string")) == "yyyy-MM-dd"
    (tmp_path / "in.csv").write_text("\n".join([HEADER, *[f"{d},T{i},Male,30,Single,Ohio,Basic,E,Card,No,1.00" for i, d in enumerate(dates[:5])]]))
    done = run_ingestion(spark, str(tmp_path / "in.csv"), str(tmp_path / "store"), date_format="infer")
    assert done["statistics"]["total_records"] == 3 and done["rejected"]["bad_date"] == 2


def test_the_nested_view_holds_the_flat_one(spark):
    sets = queries._sets_without_distinct_ids(spark, SF)
    parts = [sets[n] for n in ("customer_features", "quarterly_features", "payment_features", "state_features")]
    nested, flat = views.ml_training_nested(*parts), views.ml_training_features_alt(*parts)
    again = views.flatten_training(nested).select(*flat.columns)
    assert again.exceptAll(flat).isEmpty() and flat.exceptAll(again).isEmpty()
    assert nested.agg(F.sum("flat_rows")).first()[0] == flat.count() > 10 * nested.count()
