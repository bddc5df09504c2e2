"""Intake rules: CSV text in, typed and judged transactions out.

The order is part of the result: fill gaps, drop later copies of an id, then judge ages, amounts
and dates. A bad first copy therefore still removes a good second one.

Rows that fail a rule are not lost: `judge` marks them with a reject_reason, and the writer keeps
them apart from the good rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendgrain.functions.parsing import amount_sql, missing_to_null, money_sql, number_sql, timestamp_ntz_sql
from spendgrain.schema import MAX_AGE, MIN_AGE, MONEY, TEXT_DEFAULTS

# Ages are counted by whole year; those beyond INT, the type of the median, share one bucket on either side.
_AGE_LIMIT = 2**31 - 1

REJECT_REASONS = ("bad_record", "age_out_of_range", "negative_amount", "bad_date", "amount_out_of_range")


def standard_names(df: DataFrame) -> DataFrame:
    """Lower-case column names with underscores for spaces."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def parse(df: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Typed columns, with NULL for what is missing or unreadable; other columns pass through.

    age stays a double until it is filled. amount_value keeps the plain number for the sign and
    range rules, which must not see a rounded amount.
    """
    # No missing-value token reads as a date or number, so those columns need no look-up.
    return standard_names(df).withColumns(
        {
            **{c: missing_to_null(c) for c in ("transaction_id", *TEXT_DEFAULTS)},
            "transaction_date": F.expr(timestamp_ntz_sql("transaction_date", date_format)),
            "age": F.expr(number_sql("age")),
            "amount_value": F.expr(amount_sql("amount_spent")),
            "amount_spent": F.expr(money_sql("amount_spent")),
        }
    )


def age_profile(parsed: DataFrame) -> DataFrame:
    """One row about the parsed rows before anything is filled or dropped: rows in, missing values
    per column, bad dates and amounts, and the median age cut to a whole year.

    The median is exact but needs no sort or collection of all ages. Rows are counted by whole
    year, which leaves one small row per distinct year; two middle values in the same year bucket give that year
    whatever their fractions, and middle values in different buckets are the largest age of one
    and the smallest of the other. Bad records count as rows in, and for nothing else.
    """
    whole = _whole(parsed)
    filled = [*TEXT_DEFAULTS, "transaction_id", "transaction_date", "age", "amount_value"]
    by_year = parsed.groupBy(F.expr(f"CASE WHEN {whole} THEN CAST({_clamp('age')} AS INT) END AS bucket")).agg(
        F.expr("count(1) AS rows_in"),
        F.expr("min(age) AS lowest"),
        F.expr("max(age) AS highest"),
        *[F.expr(f"count_if({whole} AND {c} IS NULL) AS missing_{c}") for c in filled],
    )
    # One task, but over the distinct whole years only.
    known = "sum(CASE WHEN bucket IS NOT NULL THEN rows_in END)"
    ranked = by_year.selectExpr(
        "*",
        f"{known} OVER (ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS reached",
        f"{known} OVER () AS ages",
    )
    holds_low = "FILTER (WHERE bucket IS NOT NULL AND reached * 2 >= ages)"
    holds_high = "FILTER (WHERE bucket IS NOT NULL AND reached * 2 > ages)"
    summary = ranked.agg(
        F.expr("coalesce(sum(rows_in), 0) AS rows_in"),
        *[F.expr(f"coalesce(sum(missing_{c}), 0) AS missing_{c}") for c in filled],
        F.expr(f"min(struct(bucket, highest)) {holds_low} AS low"),
        F.expr(f"min(struct(bucket, lowest)) {holds_high} AS high"),
    )
    middle = _clamp("((low.highest + high.lowest) / 2)")
    median = f"CASE WHEN low.bucket = high.bucket THEN low.bucket ELSE CAST({middle} AS INT) END"
    return summary.withColumn("median_age", F.expr(median)).drop("low", "high")


def _clamp(age: str) -> str:
    """SQL: the age, or the limit it lies beyond; NULL stays NULL."""
    limit = f"CAST({_AGE_LIMIT} AS DOUBLE)"
    return f"CASE WHEN {age} > {limit} THEN {limit} WHEN {age} < -{limit} THEN -{limit} ELSE {age} END"


def _whole(df: DataFrame) -> str:
    """SQL: whether a row is a whole record. Rows that come from no CSV are."""
    return "bad_record IS NULL" if "bad_record" in df.columns else "true"


def fill_missing(parsed: DataFrame, median_age: int | Column | None = None) -> DataFrame:
    """Put the defaults in. Without a given median age it is read from the same rows by a scalar
    subquery; ages then lose their fraction.

    Fails if an age must be filled and no row has one. Ages beyond INT become NULL, which no age
    rule accepts.
    """
    if median_age is None:
        median_age = age_profile(parsed).select("median_age").scalar()
    elif not isinstance(median_age, Column):
        median_age = F.lit(median_age)
    # An amount that parsed as a number but does not fit the money type stays NULL for `judge`.
    return parsed.fillna(TEXT_DEFAULTS).withColumn("median_age", median_age.cast("double")).withColumns(
        {
            "age": F.expr(
                f"try_cast(CASE WHEN NOT ({_whole(parsed)}) OR age IS NOT NULL THEN age "
                "WHEN median_age IS NOT NULL THEN median_age "
                "ELSE raise_error('age is missing in every row: no median to fill it with') END AS INT)"
            ),
            "amount_spent": F.expr(
                f"CASE WHEN amount_value IS NULL THEN CAST(0 AS {MONEY.simpleString()}) ELSE amount_spent END"
            ),
            "amount_value": F.expr("coalesce(amount_value, CAST(0 AS DOUBLE))"),
        }
    ).drop("median_age")


def keep_first(df: DataFrame, order: Sequence[str | Column], key: str = "transaction_id") -> DataFrame:
    """The first row per id in the given order; rows without an id count as one id.

    Spark plans the rank filter as a group limit on both sides of the shuffle, so of a hot id each
    task sends a single row. A bad record is no copy of anything, whatever stands where its id should be.
    """
    keys = [F.col(key)]
    if "bad_record" in df.columns:
        keys.append(F.when(F.col("bad_record").isNotNull(), F.struct(*order)))
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(first)).filter("_copy = 1").drop("_copy")


def judge(df: DataFrame) -> DataFrame:
    """Add reject_reason: NULL for a good row, else the first rule it fails."""
    return df.withColumn(
        "reject_reason",
        F.expr(
            f"CASE WHEN NOT ({_whole(df)}) THEN 'bad_record' "
            f"WHEN NOT coalesce(age BETWEEN {MIN_AGE} AND {MAX_AGE}, false) THEN 'age_out_of_range' "
            "WHEN amount_value < 0 THEN 'negative_amount' "
            "WHEN transaction_date IS NULL THEN 'bad_date' "
            "WHEN amount_spent IS NULL THEN 'amount_out_of_range' END"
        ),
    )


def clean(
    df: DataFrame,
    order: Sequence[str | Column],
    date_format: str = "yyyy-MM-dd",
    median_age: int | None = None,
) -> DataFrame:
    """All intake rules; every first copy comes out, judged by reject_reason."""
    return judge(keep_first(fill_missing(parse(df, date_format), median_age), order)).drop("amount_value")


def accepted(judged: DataFrame) -> DataFrame:
    """Rows the age and amount rules keep, those with an unreadable date included."""
    rejected = F.col("reject_reason").isin("bad_record", "age_out_of_range", "negative_amount")
    return judged.filter(F.coalesce(~rejected, F.lit(True))).drop("reject_reason", "bad_record")


def good(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reject_reason").isNull()).drop("reject_reason", "bad_record")


def quarantined(judged: DataFrame) -> DataFrame:
    """Rows that pass the age and amount rules but cannot be filed under a month or as money."""
    return judged.filter(F.col("reject_reason").isin("bad_date", "amount_out_of_range"))


def copies_report(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows in, rows left and copies removed by keep_first, without ranking any rows."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_in"),
            F.count(F.lit(1)).alias("rows_out"),
        )
        .withColumn("duplicates_removed", F.col("rows_in") - F.col("rows_out"))
    )


def cleaning_report(df: DataFrame, order: Sequence[str | Column], date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Long form (check, rows): what each intake step filled, dropped or set aside."""
    # One subquery for the median and for the report: Spark runs equal ones once.
    profile = age_profile(parse(df, date_format))
    names = [c for c in profile.columns if c != "median_age"]
    found = profile.select(F.struct("*").alias("profile")).scalar()
    cleaned = clean(df, order, date_format, found.getField("median_age"))
    reasons = [r for r in REJECT_REASONS if r != "bad_record" or r in cleaned.columns]
    after = cleaned.groupBy().agg(
        F.count(F.lit(1)).alias("distinct_rows"),
        *[F.count_if(F.col("reject_reason") == r).alias(f"rejected_{r}") for r in reasons],
        F.count_if(F.col("reject_reason").isNull()).alias("rows_kept"),
    )
    both = after.select(found.alias("found"), "*")
    return unpivot_counts(both.select(*[f"found.{c}" for c in names], *after.columns))


def unpivot_counts(one_row: DataFrame) -> DataFrame:
    """A one-row table of counts as (check, rows)."""
    return one_row.unpivot([], one_row.columns, "check", "rows")
