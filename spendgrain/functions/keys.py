"""Row keys that stay the same when a table is computed again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_key(*columns: str) -> Column:
    """SHA-256 of the values, each behind its length, so that no two different rows make the same text.
    N stands for NULL."""
    parts = [F.col(c).cast("string") for c in columns]
    spelled = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("N")) for p in parts]
    return F.sha2(F.concat(*spelled), 256)
