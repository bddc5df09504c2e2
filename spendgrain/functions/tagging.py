"""Version and time columns on feature rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendgrain.schema import FEATURE_VERSION


def created_at(as_of: datetime | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def tag_features(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return df.withColumns({"feature_version": F.lit(FEATURE_VERSION), "created_at": created_at(as_of)})
