"""Where intermediate tables go: the shared folder the session names, never a local one on a cluster."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_base(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a folder in the warehouse, which all executors share too."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    return (base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder name for one run's tables."""
    return f"{scratch_base(spark)}/{label}-{uuid.uuid4().hex}"
