"""Exact medians of columns with any number of distinct values, by distributed selection.

Each round counts the values between two bounds in a fixed number of buckets and goes on with the bucket that holds the wanted
rank, between the smallest and largest value in it. Every round is one pass with map-side combining, and nothing larger than
the buckets reaches a task or the driver: no sort, no buffer of values, no window over distinct values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def value_at_rank(values: DataFrame, rank: int, low: float, high: float, buckets: int = BUCKETS) -> float:
    """values: x, doubles. The value with `rank` smaller or equal ones before it, between the smallest and the largest value."""
    while low < high:
        width = (high / 2 - low / 2) / buckets  # halves, as the difference itself may overflow
        x = F.col("x")
        inside = F.when(x == low, 0).otherwise(1) if width == 0 else F.least(F.floor((x / 2 - F.lit(low / 2)) / F.lit(width)), F.lit(buckets - 1))
        found = values.where(x.between(low, high)).groupBy(inside.alias("bucket")).agg(F.count("x"), F.min("x"), F.max("x"))
        for _, n, low, high in sorted(found.collect()):
            if rank < n:
                break
            rank -= n
    return low


def exact_median(df: DataFrame, column: str, buckets: int = BUCKETS) -> tuple[int, float | None]:
    """How many values the column has, and their median; NULL and NaN are no values."""
    x = F.col(column).cast("double")
    values = df.select(x.alias("x")).where("x IS NOT NULL AND NOT isnan(x)")
    n, low, high = values.agg(F.count("x"), F.min("x"), F.max("x")).first()
    if not n:
        return 0, None
    first = value_at_rank(values, (n - 1) // 2, low, high, buckets)
    if n % 2:
        return n, first
    # The next value is the same one if there are more of it, else the smallest above.
    upto, above = values.agg(F.count_if(F.col("x") <= first), F.min(F.when(F.col("x") > first, F.col("x")))).first()
    return n, (first if upto > n // 2 else first / 2 + above / 2)
