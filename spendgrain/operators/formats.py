"""Which date format a text column is written in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendgrain.functions.parsing import timestamp_ntz_sql

#: Patterns that are tried, in the order that settles ties.
CANDIDATES = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "yyyy/MM/dd", "dd.MM.yyyy", "yyyyMMdd", "yyyy-MM-dd HH:mm:ss")


def date_formats(df: DataFrame, column: str = "transaction_date", candidates: Sequence[str] = CANDIDATES, by: Sequence[str] = ()) -> DataFrame:
    """For each pattern how many values it reads, out of how many, whether it is the chosen one (it reads most; ties go to the first pattern)
    and whether others read as many. One pass for all patterns; `by` columns, such as a file's, give a report each, which shows files
    that are mixed or differ. A column that no pattern reads has none chosen."""
    reads = {f"f{i}": F.count(F.expr(timestamp_ntz_sql(column, f))) for i, f in enumerate(candidates)}
    counts = df.groupBy(*by).agg(F.count(column).alias("given"), *[c.alias(n) for n, c in reads.items()])
    entries = F.explode(F.array(*[F.struct(F.lit(f).alias("date_format"), F.lit(i).alias("place"), F.col(f"f{i}").alias("readable")) for i, f in enumerate(candidates)]))
    rows = counts.select(*by, "given", entries.alias("e")).select(*by, "given", "e.*")
    best = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    first = F.min(F.struct(-F.col("readable"), F.col("place"))).over(best)
    most = F.max("readable").over(best)
    ties = F.count_if(F.col("readable") == F.col("most")).over(best)
    judged = rows.withColumns({"first": first, "most": most}).withColumn("ties", ties)
    chosen = (F.col("first.place") == F.col("place")) & (F.col("readable") > 0)
    return judged.select(*by, "date_format", "given", "readable", chosen.alias("chosen"), (chosen & (F.col("ties") > 1)).alias("tied"))


def best_format(df: DataFrame, column: str = "transaction_date", candidates: Sequence[str] = CANDIDATES) -> str:
    """The chosen pattern; the first one where none reads anything."""
    row = date_formats(df, column, candidates).where("chosen").first()
    return row["date_format"] if row else candidates[0]
