"""Random transactions with nulls, copies, gaps, zero quarters, ties and a hot key, against plain
Python, and whatever the partitioning."""

import random
import statistics
from collections import Counter, defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendgrain.operators import cleaning, quality, views
from spendgrain.operators import features as fs
from spendgrain.operators.cohorts import customer_cohorts, customer_retention
from spendgrain.operators.statistics import ingestion_stats, value_counts

SCHEMA = (
    "transaction_date date, transaction_id string, gender string, age int, marital_status string, "
    "state_names string, segment string, employees_status string, payment_method string, referral string, "
    "amount_spent decimal(18,2), customer string"
)
NAMES = [c.split()[0] for c in SCHEMA.replace("(18,2)", "").split(", ")]


def random_rows(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.35
        rows.append(
            (
                date(2018, 1, 1) + timedelta(days=rng.choice([0, 40, 100, 300, 500, 900]) + rng.randrange(20)),
                None if rng.random() < 0.03 else f"T{rng.randrange(n)}",
                rng.choice(["Male", "Female", "Unknown"]),
                rng.randint(18, 120),
                rng.choice(["Married", "Single"]),
                None if rng.random() < 0.02 else ("Ohio" if hot else rng.choice(["Ohio", "Utah", "Iowa"])),
                None if rng.random() < 0.02 else ("Basic" if hot else rng.choice(["Basic", "Gold"])),
                "Employees",
                rng.choice(["Card", "PayPal", "Other"]),
                rng.choice(["Yes", "No", None]),
                Decimal(rng.choice([0, 0, rng.randrange(10**6)])).scaleb(-2),
                "hot" if hot else rng.choice([None, *[f"C{k}" for k in range(30)]]),
            )
        )
    return rows


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return random_rows(request.param)


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(7).cache()


def group(rows, *keys):
    places = [NAMES.index(k) for k in keys]
    out = defaultdict(list)
    for r in rows:
        out[tuple(r[p] for p in places)].append(r)
    return out


def test_customer_features(df, rows):
    found = {(r["segment"], r["state_names"]): r for r in fs.customer_features(df).collect()}
    expected = group(rows, "segment", "state_names")
    assert set(found) == set(expected)
    for key, members in expected.items():
        r, amounts = found[key], [m[10] for m in members]
        days = [m[0] for m in members]
        n = sum(m[1] is not None for m in members)
        assert r["total_transactions"] == n and r["total_amount_spent"] == sum(amounts)
        assert r["avg_transaction_amount"] == pytest.approx(float(sum(amounts)) / len(amounts))
        if len(amounts) > 1:
            assert r["std_transaction_amount"] == pytest.approx(statistics.stdev(map(float, amounts)))
        else:
            assert r["std_transaction_amount"] is None
        assert r["days_active"] == (max(days) - min(days)).days
        assert r["referral_rate"] == pytest.approx(sum(m[9] == "Yes" for m in members) / len(members))
        assert r["avg_days_between_transactions"] == (pytest.approx(r["days_active"] / n) if n else None)


def test_quarterly_and_state_distinct_ids(df, rows):
    quarterly = {
        (r["year"], r["quarter"], r["segment"], r["state_names"]): r["unique_customers"]
        for r in fs.quarterly_features(df).collect()
    }
    expected = defaultdict(set)
    for r in rows:
        expected[(r[0].year, (r[0].month + 2) // 3, r[6], r[5])].add(r[1])
    assert quarterly == {k: len(v - {None}) for k, v in expected.items()}
    states = {r["state_names"]: r for r in fs.state_features(df).collect()}
    for (state,), members in group(rows, "state_names").items():
        assert states[state]["total_customers"] == len({m[1] for m in members} - {None})
        counts = Counter()
        for m in members:
            counts[m[8]] += m[1] is not None
        best = min(counts, key=lambda v: (-counts[v], v))
        assert states[state]["top_payment_method"] == (None if state is None else best)


def test_growth_follows_present_quarters(df):
    last = {}
    for r in sorted(fs.quarterly_features(df).collect(), key=lambda r: (r["year"], r["quarter"])):
        key = (r["segment"], r["state_names"])
        previous = last.get(key)
        if previous is None:
            assert r["revenue_growth_rate"] == 0
        elif previous == 0:
            assert r["revenue_growth_rate"] is None
        else:
            assert r["revenue_growth_rate"] == pytest.approx(float((r["quarterly_revenue"] - previous) / previous))
        last[key] = r["quarterly_revenue"]


def test_cohorts_and_retention(df, rows):
    active = defaultdict(set)
    for r in rows:
        active[(r[6], r[5], r[0].year * 4 + (r[0].month + 2) // 3 - 1)].add(r[11])
    active = {k: v - {None} for k, v in active.items()}
    found = {
        (r["segment"], r["state_names"], r["year"] * 4 + r["quarter"] - 1): r
        for r in customer_cohorts(df, "customer").collect()
    }
    kept = {
        (r["segment"], r["state_names"], r["year"] * 4 + r["quarter"] - 1): r
        for r in customer_retention(df, "customer").collect()
    }
    assert set(found) == set(kept) == set(active)
    for key in active:
        earlier = sorted(k[2] for k in active if k[:2] == key[:2] and k[2] < key[2])
        seen = set().union(*[active[(*key[:2], q)] for q in earlier])
        assert found[key]["unique_customers"] == len(active[key])
        assert found[key]["new_customers"] == len(active[key] - seen)
        assert found[key]["returning_customers"] == len(active[key] & seen)
        if not earlier:
            assert (kept[key]["retained_customers"], kept[key]["customer_retention_rate"]) == (0, None)
        else:
            before = active[(*key[:2], earlier[-1])]
            assert kept[key]["retained_customers"] == len(active[key] & before)
            rate = len(active[key] & before) / len(before) if before else None
            assert kept[key]["customer_retention_rate"] == (None if rate is None else pytest.approx(rate))


def test_invariants(df, rows):
    sets = [f(df) for f in (fs.customer_features, fs.quarterly_features, fs.payment_features, fs.state_features)]
    for r in quality.feature_invariants(df, *sets).collect():
        assert r["passed"], r["invariant"]


def test_statistics(df, rows):
    r = ingestion_stats(df).first()
    assert r["total_records"] == len(rows) == sum(Counter(x[8] for x in rows).values())
    assert r["unique_customers"] == len({x[1] for x in rows}) and r["states_count"] == len({x[5] for x in rows})
    assert r["segments"] == {k: v for k, v in Counter(x[6] for x in rows).items() if k is not None}
    assert r["avg_transaction"] == pytest.approx(float(sum(x[10] for x in rows)) / len(rows))
    histogram = [(x["segment"], x["row_count"]) for x in value_counts(df, "segment").collect()]
    assert histogram == sorted(r["segments"].items(), key=lambda kv: (-kv[1], kv[0]))


def test_sketch_is_close(df, rows):
    exact = {k: len({m[1] for m in v} - {None}) for k, v in group(rows, "payment_method").items()}
    for r in fs.approx_customers(df, "payment_method").collect():
        assert r["approx_customers"] == pytest.approx(exact[(r["payment_method"],)], rel=0.1)


def test_training_rows_per_group(df, rows):
    from spendgrain.functions.calendar import with_quarters
    from spendgrain.functions.measures import measures
    from spendgrain.operators.cohorts import cohort_counts, customer_moves, full_quarterly

    named = df.filter("segment is not null and state_names is not null")
    quarterly = full_quarterly(
        measures(with_quarters(named), *fs.QUARTER_KEYS), cohort_counts(customer_moves(named, "customer"))
    )
    customer, state = fs.customer_features(named), fs.state_features(named)
    assert views.ml_training_features(customer, quarterly, state).count() == quarterly.count()
    assert views.ml_training_latest(customer, quarterly, state).count() == customer.count()


def test_results_do_not_depend_on_partitioning(spark, rows):
    def results(partitions, shuffles, adaptive):
        keys = {"spark.sql.shuffle.partitions": str(shuffles), "spark.sql.adaptive.enabled": adaptive}
        before = {k: spark.conf.get(k) for k in keys}
        for k, v in keys.items():
            spark.conf.set(k, v)
        try:
            data = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
            return [
                sorted(map(str, f(data).drop("created_at").collect()))
                for f in (fs.customer_features, fs.quarterly_features, fs.payment_features, fs.state_features)
            ]
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)

    first = results(1, 1, "true")
    assert results(13, 5, "true") == first
    assert results(4, 9, "false") == first


def test_keep_first_with_a_hot_id(spark):
    rows = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 'hot' ELSE CAST(id AS STRING) END AS transaction_id",
        "30000 - id AS seq",
    )
    kept = cleaning.keep_first(rows.repartition(6), ["seq"])
    found = kept.groupBy().agg(
        F.count("*").alias("n"),
        F.min(F.expr("CASE WHEN transaction_id IS NULL THEN seq END")).alias("nameless"),
        F.min(F.expr("CASE WHEN transaction_id = 'hot' THEN seq END")).alias("hot"),
    )
    assert found.first().asDict() == {"n": 10_002, "nameless": 3, "hot": 2}


def test_file_order_survives_splitting(spark, tmp_path):
    """A CSV cut into many splits keeps the copies that a reader from top to bottom keeps."""
    from spendgrain.sources.files import file_order, read_csv
    from tests.test_golden import HEADER

    rng = random.Random(3)
    lines, first = [], {}
    for i in range(4000):
        number = rng.randrange(1500)
        first.setdefault(f"T{number}", f"{i}.00")
        lines.append(f"2018-01-05,T{number},Male,30,Single,Ohio,Basic,Employees,Card,No,{i}.00")
    (tmp_path / "one.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = read_csv(spark, str(tmp_path / "one.csv"))
        assert scan.rdd.getNumPartitions() > 5
        kept = cleaning.clean(scan, file_order(scan), median_age=30).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r["transaction_id"]: str(r["amount_spent"]) for r in kept} == first
