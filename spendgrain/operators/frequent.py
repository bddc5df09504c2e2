"""Frequent values of columns with an unbounded number of values.

A first pass keeps a summary of fixed size per task, which misses no value that has the wanted share of all rows; a second
one counts exactly what the summary holds. All other values are one entry, so that neither a map nor a shuffle grows with the
number of distinct values.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frequent_values(df: DataFrame, column: str, share: float = 0.001) -> DataFrame:
    """value (as text), row_count and other: the values with at least `share` of the rows that have one, and one row with other = true
    for the rest, if there is any."""
    given = df.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL")
    # The summary holds every value with more than 2 * 3.5 / size of the rows; the size is a power of two.
    size = 2 ** (ceil(8 / share) - 1).bit_length()
    summary = given.agg(F.expr(f"approx_top_k(value, {min(size, ceil(2 / share))}, {size})").alias("top"), F.count("value").alias("total"))
    survivors = F.broadcast(summary.select(F.explode("top.item").alias("kept")))  # at most 2 / share of them
    counted = given.join(survivors, F.col("value") == F.col("kept"), "left").groupBy(F.col("kept").alias("value")).agg(F.count("*").alias("n"))
    total = given.agg(F.count("value").alias("total")).scalar()
    judged = counted.withColumn("other", F.col("value").isNull() | (F.col("n") < share * total))
    return judged.groupBy(F.when(~F.col("other"), F.col("value")).alias("value"), "other").agg(F.sum("n").alias("row_count")).select("value", "row_count", "other")
