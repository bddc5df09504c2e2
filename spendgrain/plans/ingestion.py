"""One ingestion run: CSV files into the monthly table, with statistics and a metadata document."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendgrain.operators.cleaning import REJECT_REASONS, age_profile, clean, parse, standard_names
from spendgrain.operators.formats import best_format
from spendgrain.operators.statistics import STATISTICS, batch_summary
from spendgrain.sources.files import FILE_ORDER, file_order, read_csv, read_stored, write_monthly
from spendgrain.sources.store import append_log, log_entry, one_row, write_metadata

INGESTION = "monthly_data_ingestion"


def run_ingestion(
    spark: SparkSession,
    csv_path: str,
    root: str,
    as_of: datetime | None = None,
    date_format: str = "yyyy-MM-dd",
    csv_options: Mapping[str, str] | None = None,
) -> dict:
    """Clean `csv_path` into root/raw and return the metadata document as a dict.

    Three passes, whatever the size: (1) the CSV, for the counts and the median age that the
    cleaning needs beforehand; (2) the CSV again, cleaned and written once, accepted and rejected
    rows together; (3) the columns of the written batch that the statistics need. Counts come from
    data, not from task counters, so a task that runs twice does not count twice. Only files
    changed since the day before the run are read back.

    `csv_options` go to the CSV reader; {"quotedBreaks": "true"} reads line breaks inside quotes.
    date_format="infer" takes the pattern that reads most dates, found in one more pass.
    """
    started = datetime.now()
    as_of = as_of or started
    try:
        scan = read_csv(spark, csv_path, **(csv_options or {}))
        if date_format == "infer":
            date_format = best_format(standard_names(scan))
        # Only these two columns of the profile: of a line only the age goes further than the parser.
        profile = age_profile(parse(scan, date_format)).select("rows_in", "median_age").first()
        batch_id = uuid.uuid4().hex
        cleaned = clean(scan, file_order(scan), date_format, profile["median_age"])
        batch = cleaned.drop(*FILE_ORDER).withColumn("batch_id", F.lit(batch_id))
        write_monthly(batch, f"{root}/raw")

        # The storage's clock may differ from the driver's; a day is more than it can.
        changed = F.col("_metadata.file_modification_time") >= F.lit(started - timedelta(days=1))
        recent = read_stored(spark, f"{root}/raw", batch.schema).filter(changed)
        written = recent.filter(F.col("batch_id") == batch_id)
        good_files = written.filter("year IS NOT NULL").select(F.col("_metadata.file_path").alias("file")).distinct()
        summary = batch_summary(written).select(F.struct(*STATISTICS).alias("statistics"), "rejected")
        row = summary.first()
        document = {
            "ingestion_date": as_of,
            "source_file": csv_path,
            "files_created": good_files.count(),
            "statistics": row["statistics"].asDict(recursive=True),
            "execution_time_seconds": (datetime.now() - started).total_seconds(),
        }
        write_metadata(one_row(spark, document, document_schema(summary)), f"{root}/processed")
    except Exception as error:
        append_log(spark, root, log_entry(INGESTION, "failed", 0, started, datetime.now(), error=str(error)))
        raise
    rejected = {reason: row["rejected"].get(reason, 0) for reason in REJECT_REASONS}
    kept = document["statistics"]["total_records"]
    append_log(
        spark,
        root,
        log_entry(
            INGESTION,
            "completed",
            profile["rows_in"],
            started,
            datetime.now(),
            inserted=kept,
            failed=sum(rejected.values()),
            metadata={"source_file": csv_path, "batch_id": batch_id},
        ),
    )
    return {
        **document,
        "rows_in": profile["rows_in"],
        "median_age": profile["median_age"],
        "duplicates_removed": profile["rows_in"] - kept - sum(rejected.values()),
        "rejected": rejected,
    }


def document_schema(summary: DataFrame) -> T.StructType:
    """Schema of the nested ingestion document."""
    return T.StructType(
        [
            T.StructField("ingestion_date", T.TimestampType()),
            T.StructField("source_file", T.StringType()),
            T.StructField("files_created", T.LongType()),
            T.StructField("statistics", summary.schema["statistics"].dataType),
            T.StructField("execution_time_seconds", T.DoubleType()),
        ]
    )
