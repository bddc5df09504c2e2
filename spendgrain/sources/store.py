"""Sinks of the feature store: Parquet sets, dated snapshots, JDBC tables, run metadata, run log."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendgrain.schema import STORE_TABLES

LOG_TABLE = "pipeline_execution_log"


def write_features(df: DataFrame, root: str, name: str) -> str:
    path = f"{root}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_features(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def with_snapshot_date(df: DataFrame, snapshot_date: date) -> DataFrame:
    return df.withColumn("snapshot_date", F.lit(snapshot_date))


def write_snapshot(df: DataFrame, root: str, name: str, snapshot_date: date) -> None:
    """Keep a dated copy; a second run on the same date replaces that date only."""
    (
        with_snapshot_date(df, snapshot_date)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(f"{root}/{name}")
    )


def jdbc_ready(df: DataFrame) -> DataFrame:
    """Map columns as JSON text, since JDBC has no map type."""
    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
    return df.withColumns({c: F.to_json(c) for c in maps})


def jdbc_settings(env: Mapping[str, str] | None = None) -> tuple[str, dict[str, str]]:
    """URL and properties from POSTGRES_HOST, _PORT, _DB, _USER and _PASSWORD."""
    env = os.environ if env is None else env
    host, port = env.get("POSTGRES_HOST", "postgres"), env.get("POSTGRES_PORT", "5432")
    url = f"jdbc:postgresql://{host}:{port}/{env.get('POSTGRES_DB', 'feature_store')}"
    properties = {"driver": "org.postgresql.Driver", "user": env.get("POSTGRES_USER", "")}
    if "POSTGRES_PASSWORD" in env:
        properties["password"] = env["POSTGRES_PASSWORD"]
    return url, properties


def write_jdbc(
    df: DataFrame,
    table: str,
    mode: str = "append",
    url: str | None = None,
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
) -> None:
    """Write a conformed table over at most `connections` parallel connections. Overwriting empties the
    target and keeps its definition, primary key included.

    A task that is run again sends its rows again; the stable key column lets a primary key on
    the target refuse them.
    """
    if url is None:
        url, defaults = jdbc_settings()
        properties = {**defaults, **(properties or {})}
    properties = {**({"truncate": "true"} if mode == "overwrite" else {}), **(properties or {})}
    # A shuffle, so that what comes before the write keeps its own parallelism.
    jdbc_ready(df).repartition(connections).write.jdbc(url, table, mode=mode, properties=properties)


def write_metadata(document: DataFrame, root: str) -> None:
    """Add one ingestion document; it has an ingestion_date timestamp column."""
    (
        document.withColumn("ingest_day", F.to_date("ingestion_date"))
        .write.mode("append")
        .partitionBy("ingest_day")
        .json(f"{root}/ingestion_metadata")
    )


def one_row(spark: SparkSession, values: Mapping[str, object], schema: T.StructType) -> DataFrame:
    """A one-row table of literals under an explicit schema; absent fields are NULL. Unlike a table
    made from Python objects it needs no Python worker."""
    text = json.dumps(dict(values), default=str)
    return spark.range(0, 1, 1, 1).select(F.from_json(F.lit(text), schema).alias("row")).select("row.*")


def log_rows(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Execution log rows with the full declared schema; absent fields are NULL."""
    schema = STORE_TABLES[LOG_TABLE]
    rows = [
        tuple(({"execution_id": str(uuid.uuid4()), **entry}).get(name) for name in schema.names)
        for entry in entries
    ]
    return spark.createDataFrame(rows, schema)


def log_entry(
    pipeline_name: str,
    status: str,
    records: int,
    started: datetime,
    ended: datetime,
    inserted: int | None = None,
    failed: int | None = None,
    error: str | None = None,
    metadata: dict[str, str] | None = None,
) -> dict:
    if status not in ("started", "completed", "failed"):
        raise ValueError(f"unknown status: {status}")
    return {
        "pipeline_name": pipeline_name,
        "execution_date": ended,
        "status": status,
        "records_processed": records,
        "records_inserted": inserted,
        "records_updated": 0,
        "records_failed": failed,
        "start_time": started,
        "end_time": ended,
        "execution_time_seconds": int((ended - started).total_seconds()),
        "error_message": error,
        "metadata": metadata,
    }


def append_log(spark: SparkSession, root: str, entry: Mapping[str, object]) -> None:
    row = one_row(spark, {"execution_id": str(uuid.uuid4()), **entry}, STORE_TABLES[LOG_TABLE])
    row.write.mode("append").parquet(f"{root}/{LOG_TABLE}")


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{LOG_TABLE}")
