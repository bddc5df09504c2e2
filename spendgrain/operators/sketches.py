"""Customer counts that merge: one pass over the transactions leaves small sets per quarter and group, and every coarser count, and
the cohorts, come from those without meeting a customer again.

* HyperLogLog sketches: distinct customers at any grain, within some 1.6 % (one deviation) at 12 bits.
* Theta sketches: unions, differences and intersections of quarters, so new, returning and retained customers; exact up to 2**bits
  customers, with a bound of the error beyond.
* Bitmaps: exact counts of the same, where customers have dense numbers. A bitmap is 4,096 bytes for 32,768 neighbouring numbers.

All three are plain columns: store them with the features and merge them with later quarters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendgrain.functions.calendar import quarter_number, quarter_parts
from spendgrain.operators.features import CUSTOMER_KEYS, QUARTER_KEYS, join_on_keys

BITS = 12


def customer_sketches(df: DataFrame, customer_col: str = "transaction_id", bits: int = BITS) -> DataFrame:
    """(segment, state, quarter_no) with the sketches hll and theta of the customers active there. Map-side combining leaves one
    sketch per group and task to shuffle."""
    customer = F.col(customer_col).cast("string")
    return df.groupBy(*CUSTOMER_KEYS, F.expr(quarter_number("transaction_date")).alias("quarter_no")).agg(
        F.hll_sketch_agg(customer, bits).alias("hll"), F.theta_sketch_agg(customer, bits).alias("theta")
    )


def distinct_customers(sketches: DataFrame, *keys: str, bits: int = BITS) -> DataFrame:
    """Estimated customers at a grain of the sketches or a coarser one, and three deviations of the estimate."""
    merged = sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("customers_estimate"))
    return merged.withColumn("bound", F.ceil(3 * 1.04 * 2 ** (-bits / 2) * F.col("customers_estimate")))


def sketch_cohorts(sketches: DataFrame, bits: int = BITS) -> DataFrame:
    """Per group and quarter: estimated unique, new, returning and retained customers, and the largest of their bounds (three deviations;
    0 where the sketches hold all customers)."""
    in_order = Window.partitionBy(*CUSTOMER_KEYS).orderBy("quarter_no")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.theta_sketch_estimate
    known = sketches.withColumns({"earlier": F.theta_union_agg("theta", bits).over(before), "previous": F.lag("theta").over(in_order)})
    counted = known.select(
        *CUSTOMER_KEYS,
        "quarter_no",
        size("theta").alias("unique_customers"),
        F.coalesce(size(F.theta_difference("theta", "earlier")), size("theta")).alias("new_customers"),
        F.coalesce(size(F.theta_intersection("theta", "previous")), F.lit(0)).alias("retained_customers"),
        F.coalesce(size(F.theta_union("theta", "earlier", F.lit(bits))), size("theta")).alias("reached"),
    )
    # A part of m of N customers is estimated from the 2**bits smallest hashes: its deviation is sqrt(m * N / 2**bits) at most.
    error = F.ceil(3 * F.sqrt(F.col("unique_customers") * F.col("reached") / 2**bits))
    return counted.select(
        *CUSTOMER_KEYS,
        *[F.expr(sql).alias(name) for name, sql in quarter_parts("quarter_no").items()],
        "unique_customers",
        "new_customers",
        (F.col("unique_customers") - F.col("new_customers")).alias("returning_customers"),
        "retained_customers",
        F.when(F.col("reached") <= 2**bits, 0).otherwise(error).cast("long").alias("bound"),
    )


def customer_bitmaps(df: DataFrame, customer_col: str) -> DataFrame:
    """(segment, state, quarter_no, block, bitmap) of numbered customers. A group and quarter with unknown customers only keeps an empty one."""
    number = F.col(customer_col)
    return df.groupBy(*CUSTOMER_KEYS, F.expr(quarter_number("transaction_date")).alias("quarter_no"), F.bitmap_bucket_number(number).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap")
    )


def counted_customers(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Exact customers at a grain of the bitmaps or a coarser one. Blocks are merged one by one, so that no row grows."""
    blocks = bitmaps.groupBy(*keys, "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return blocks.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias("customers"))


def bitmap_cohorts(bitmaps: DataFrame) -> DataFrame:
    """Per group and quarter: exact unique, new, returning and retained customers."""
    in_group = Window.partitionBy(*CUSTOMER_KEYS).orderBy("quarter_no")
    present = bitmaps.select(*CUSTOMER_KEYS, "quarter_no").distinct()
    present = present.withColumn("group_previous", F.lag("quarter_no").over(in_group))
    in_block = Window.partitionBy(*CUSTOMER_KEYS, "block").orderBy("quarter_no")

    def union_size(first: int) -> Column:
        """Customers of the block's quarters from `first` (relative) to this one."""
        return F.bitmap_count(F.bitmap_or_agg("bitmap").over(in_block.rowsBetween(first, Window.currentRow)))

    sized = bitmaps.select(
        *CUSTOMER_KEYS,
        "quarter_no",
        "block",
        F.bitmap_count("bitmap").alias("own"),
        F.lag("quarter_no").over(in_block).alias("block_previous"),
        F.lag(F.bitmap_count("bitmap")).over(in_block).alias("before"),
        union_size(Window.unboundedPreceding).alias("reached"),
        union_size(-1).alias("both"),
    )
    fresh = F.col("reached") - F.coalesce(F.lag("reached").over(in_block), F.lit(0))
    grown = join_on_keys(sized.withColumn("fresh", fresh), present, (*CUSTOMER_KEYS, "quarter_no"))
    kept = F.when(F.col("block_previous") == F.col("group_previous"), F.col("own") + F.col("before") - F.col("both"))
    counted = grown.groupBy(*CUSTOMER_KEYS, "quarter_no").agg(
        F.sum("own").alias("unique_customers"), F.sum("fresh").alias("new_customers"), F.coalesce(F.sum(kept), F.lit(0)).alias("retained_customers")
    )
    return counted.select(
        *CUSTOMER_KEYS,
        *[F.expr(sql).alias(name) for name, sql in quarter_parts("quarter_no").items()],
        "unique_customers",
        "new_customers",
        (F.col("unique_customers") - F.col("new_customers")).alias("returning_customers"),
        "retained_customers",
    )


def checked_cohorts(sketched: DataFrame, exact: DataFrame) -> DataFrame:
    """Exact cohort counts, and whether the sketched ones are within their bound."""
    counts = ("unique_customers", "new_customers", "returning_customers", "retained_customers")
    renamed = sketched.withColumnsRenamed({c: f"{c}_estimate" for c in counts})
    both = join_on_keys(exact, renamed, QUARTER_KEYS)
    return both.withColumn("within_bounds", _all([F.abs(F.col(c) - F.col(f"{c}_estimate")) <= F.col("bound") for c in counts])).select(
        *QUARTER_KEYS, *counts, "within_bounds"
    )


def _all(tests: Sequence[Column]) -> Column:
    whole = tests[0]
    for test in tests[1:]:
        whole &= test
    return whole
