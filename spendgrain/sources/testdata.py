"""The transaction table over the given test tables: orders joined to customer and nation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_to_transactions(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Join strategies are left to Spark, which broadcasts a side only below its size limit."""
    joined = orders.join(customer, F.expr("o_custkey = c_custkey")).join(
        nation, F.expr("c_nationkey = n_nationkey")
    )
    return joined.selectExpr(
        "CAST(o_orderkey AS STRING) AS transaction_id",
        "CAST(o_orderdate AS DATE) AS transaction_date",
        "CASE o_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Unknown' END AS gender",
        "CAST(18 + o_custkey % 63 AS INT) AS age",
        "CASE o_custkey % 2 WHEN 0 THEN 'Married' ELSE 'Single' END AS marital_status",
        "n_name AS state_names",
        "c_mktsegment AS segment",
        "CASE o_custkey % 4 WHEN 0 THEN 'Employed' WHEN 1 THEN 'Self-employed' WHEN 2 THEN 'Unemployed' "
        "ELSE 'Unknown' END AS employees_status",
        "o_orderpriority AS payment_method",
        "CASE WHEN o_orderkey % 4 = 0 THEN 'Yes' ELSE 'No' END AS referral",
        "CAST(o_totalprice AS DECIMAL(10,2)) AS amount_spent",
        "o_custkey AS customer_key",
        "o_orderkey AS seq",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_to_transactions(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    )


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as CSV-like text under the CSV's header names, with faults put in by
    arithmetic on seq, and every tenth transaction repeated later with another amount."""
    rows = transactions(spark, sf_dir).selectExpr(
        "CASE WHEN seq % 97 = 0 THEN 'not-a-date' ELSE CAST(transaction_date AS STRING) END AS Transaction_date",
        "transaction_id AS Transaction_ID",
        "gender AS Gender",
        "CASE WHEN seq % 17 = 0 THEN NULL WHEN seq % 101 = 0 THEN '17' WHEN seq % 103 = 0 THEN '121' "
        "ELSE CAST(age AS STRING) END AS Age",
        "marital_status AS Marital_status",
        "CASE WHEN seq % 13 <> 0 THEN state_names END AS State_names",
        "CASE WHEN seq % 19 <> 0 THEN segment END AS Segment",
        "employees_status AS Employees_status",
        "payment_method AS Payment_method",
        "referral AS Referral",
        "CASE WHEN seq % 29 = 0 THEN 'abc' WHEN seq % 31 = 0 THEN '-5.00' WHEN seq % 37 = 0 THEN NULL "
        "ELSE CAST(amount_spent AS STRING) END AS first_amount",
        "seq AS first_seq",
    )
    # One scan gives both copies: an array with one entry per copy of the row.
    first = "named_struct('Amount_spent', first_amount, 'seq', first_seq)"
    second = "named_struct('Amount_spent', '1.00', 'seq', first_seq + 1000000000)"
    copies = f"CASE WHEN first_seq % 10 = 0 THEN array({first}, {second}) ELSE array({first}) END"
    return rows.selectExpr("* EXCEPT (first_amount, first_seq)", f"inline({copies})")
