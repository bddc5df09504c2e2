"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_months(df: DataFrame, date_column: str = "transaction_date") -> DataFrame:
    """Add year, month and year_month ('yyyy-MM')."""
    date = F.col(date_column)
    return df.withColumns(
        {"year": F.year(date), "month": F.month(date), "year_month": F.date_format(date, "yyyy-MM")}
    )


def with_quarters(df: DataFrame, date_column: str = "transaction_date") -> DataFrame:
    date = F.col(date_column)
    return df.withColumns({"year": F.year(date), "quarter": F.quarter(date)})


def quarter_number(date: str) -> str:
    """SQL for quarters counted from year 0, so that consecutive quarters differ by one."""
    return f"year({date}) * 4 + quarter({date}) - 1"


def quarter_parts(number: str) -> dict[str, str]:
    """SQL back from quarter_number to year and quarter."""
    return {"year": f"CAST({number} DIV 4 AS INT)", "quarter": f"CAST({number} % 4 + 1 AS INT)"}
