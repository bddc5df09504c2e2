"""Incremental intake: in steps as in one go."""

import pytest
from pyspark.sql import functions as F

from spendgrain.operators.features import quarterly_features
from spendgrain.sources.files import read_raw, read_stored
from spendgrain.streaming.intake import absorb_into, read_csv_stream, start_intake, stored_quarterly
from tests.test_golden import HEADER


def line(number, day, state="Ohio", amount="10.00", age="30"):
    return f"{day},T{number},Male,{age},Single,{state},Basic,Employees,Card,No,{amount}"


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def take_in(spark, folder, root):
    start_intake(read_csv_stream(spark, str(folder)), root, f"{root}/checkpoint", 30).awaitTermination()


def ids(spark, root):
    return sorted(r["transaction_id"] for r in read_raw(spark, f"{root}/raw").collect())


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture
def places(tmp_path):
    return tmp_path / "incoming", str(tmp_path / "store")


def test_two_files_equal_their_union(spark, places, tmp_path):
    folder, root = places
    first = [line(i, f"2018-0{1 + i % 6}-1{i % 9}", amount=f"{i}.50") for i in range(1, 20)]
    second = [line(i, f"2018-0{4 + i % 6}-1{i % 9}", state="Utah") for i in range(20, 40)]
    put(folder, "a.csv", first)
    take_in(spark, folder, root)
    put(folder, "b.csv", second)
    take_in(spark, folder, root)
    whole, whole_root = tmp_path / "whole", str(tmp_path / "whole-store")
    put(whole, "all.csv", first + second)
    take_in(spark, whole, whole_root)
    assert same(read_raw(spark, f"{root}/raw"), read_raw(spark, f"{whole_root}/raw"))
    quarters = stored_quarterly(spark, root).drop("created_at")
    assert same(quarters, stored_quarterly(spark, whole_root).drop("created_at"))
    assert same(quarters, quarterly_features(read_raw(spark, f"{root}/raw")).drop("created_at"))


def test_stored_ids_are_not_taken_again(spark, places):
    folder, root = places
    put(folder, "a.csv", [line(1, "2018-01-05"), line(2, "2018-01-06", age="17"), "2018-01-07,,F,40,M,Ohio,Basic,E,Card,No,1.00"])
    take_in(spark, folder, root)
    put(
        folder,
        "b.csv",
        [
            line(1, "2018-02-05", amount="99.00"),
            line(2, "2018-02-06"),
            line(3, "2018-02-07"),
            line(3, "2018-02-08"),
            "2018-02-07,,F,40,M,Ohio,Basic,E,Card,No,2.00",
        ],
    )
    take_in(spark, folder, root)
    rows = {r["transaction_id"]: str(r["amount_spent"]) for r in read_raw(spark, f"{root}/raw").collect()}
    # The first copy counts: T1 as stored, T2 stays rejected, one row without an id.
    assert rows == {"T1": "10.00", None: "1.00", "T3": "10.00"}
    assert read_stored(spark, f"{root}/raw").filter("reject_reason is not null").count() == 1


def test_a_repeated_micro_batch_changes_nothing(spark, places):
    folder, root = places
    put(folder, "a.csv", [line(i, f"2018-01-0{i}") for i in range(1, 6)])
    scan = (
        spark.read.schema(", ".join(f"{c} string" for c in HEADER.split(",")))
        .option("header", True)
        .csv(str(folder))
        .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    )
    absorb = absorb_into(root, 30)
    absorb(scan, 0)
    before = stored_quarterly(spark, root).drop("created_at").collect()
    absorb(scan, 0)
    assert ids(spark, root) == [f"T{i}" for i in range(1, 6)]
    assert stored_quarterly(spark, root).drop("created_at").collect() == before


def test_small_batches_take_everything(spark, places):
    folder, root = places
    for i in range(1, 6):
        put(folder, f"{i}.csv", [line(i, f"2018-0{i}-05"), line(100 + i, f"2018-0{i}-06")])
    stream = read_csv_stream(spark, str(folder), files_per_trigger=2)
    start_intake(stream, root, f"{root}/checkpoint", 30).awaitTermination()
    assert len(ids(spark, root)) == 10


def test_a_batch_with_nothing_good_leaves_a_readable_store(spark, places):
    folder, root = places
    put(folder, "a.csv", [line(1, "2018-01-05", age="17"), '2018-01-05,T2,Male,30,Single,"New', 'York",Basic,E,Card,No,1.00'])
    take_in(spark, folder, root)
    assert stored_quarterly(spark, root).count() == 0
    # The halves of a broken record take no id from a good one.
    put(folder, "b.csv", [line(2, "2018-01-06")])
    take_in(spark, folder, root)
    assert ids(spark, root) == ["T2"]
    assert read_stored(spark, f"{root}/raw").filter("reject_reason is not null").count() == 3
