"""Turn CSV text into typed values without ever failing the job on a bad one.

Each function takes a column name and gives one SQL expression; an expression text costs a single
call into the JVM, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendgrain.functions.literals import sql_text
from spendgrain.schema import MONEY, NA_TOKENS

# Plain decimal or exponent notation, or a signed infinity. Spark's own cast also takes 'NaN' and
# Java suffixes such as '1.5f' and '12D', which the intake rules treat as bad numbers.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"

_TOKENS = ", ".join(sql_text(t) for t in NA_TOKENS)


def missing_to_null(name: str) -> Column:
    return F.expr(f"CASE WHEN {name} NOT IN ({_TOKENS}) THEN {name} END")


def number_sql(name: str) -> str:
    """A text that ends in a digit and has no hexadecimal x is a number whenever the cast takes
    it; only other texts need the slower pattern."""
    plain = f"right({name}, 1) BETWEEN '0' AND '9' AND NOT contains({name}, 'x') AND NOT contains({name}, 'X')"
    return f"CASE WHEN ({plain}) OR {name} RLIKE r'{NUMBER_PATTERN}' THEN try_cast({name} AS DOUBLE) END"


def money_sql(name: str) -> str:
    """Exact cents straight from the text; NULL when bad, infinite or too large."""
    return f"try_cast({name} AS {MONEY.simpleString()})"


def amount_sql(name: str) -> str:
    """The number behind money_sql, for rules that must not see a rounded amount. Only a text that
    rounds to zero or does not fit is read a second time."""
    money = money_sql(name)
    return f"CASE WHEN {money} <> 0 THEN CAST({money} AS DOUBLE) ELSE {number_sql(name)} END"


def timestamp_ntz_sql(name: str, pattern: str) -> str:
    """Parse with one explicit pattern; a text that does not fit it becomes NULL."""
    if pattern == "yyyy-MM-dd":
        # Spark's plain cast is several times faster than a pattern, but takes more forms; the
        # date must read back as the same text.
        day = f"try_cast({name} AS DATE)"
        return f"CASE WHEN CAST({day} AS STRING) = {name} THEN CAST({day} AS TIMESTAMP_NTZ) END"
    reader = "try_to_timestamp" if "h" in pattern.lower() else "try_to_date"
    return f"CAST({reader}({name}, {sql_text(pattern)}) AS TIMESTAMP_NTZ)"
