"""CSV intake and the monthly Parquet table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendgrain.functions.calendar import with_months
from spendgrain.schema import MONEY, REQUIRED_COLUMNS
from spendgrain.sources.records import read_records

# Columns that place a row within the scanned files, taken at the scan before any shuffle.
FILE_ORDER = ("_file", "_block", "_row")

# The text of a CSV line that is no whole record: it has too few or too many fields, as the two
# halves of a record with a line break inside quotes do.
BAD_RECORD = "bad_record"

# How CSV is read, in batches and streams. Without column pruning in the parser, so that a line's
# fields are counted whatever columns a step asks for.
CSV_OPTIONS = {
    "header": True,
    "enforceSchema": False,
    "quote": '"',
    "escape": '"',
    "columnNameOfCorruptRecord": BAD_RECORD,
    "columnPruning": False,
}

# Own option of read_csv: line breaks inside quotes belong to the record.
QUOTED_BREAKS = "quotedBreaks"

_PARTITIONS = [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
_REJECTED_IN = "rejected_in"
_FOLDERS = ("year", "month", _REJECTED_IN)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Header names of the (first) CSV file; only its first line is read."""
    try:
        return spark.read.option("header", True).csv(path).columns
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"CSV file not found: {path}") from error
        raise


def check_columns(columns: Iterable[str]) -> bool:
    """True, or ValueError naming the required columns that are absent (case matters)."""
    missing = sorted(set(REQUIRED_COLUMNS) - set(columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return True


def read_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """All columns as text, bad_record, and the row's place in the files.

    Files are split and read in parallel; every line is a record, and one that is not whole has its
    text in bad_record. Line breaks inside quotes are read with quotedBreaks="true", still by many tasks
    per file at the price of one shuffle, or with Spark's multiLine="true", one task per file;
    without either a line that breaks within its last column passes as whole. Every file's header is checked against the first one's.
    """
    columns = csv_header(spark, path)
    check_columns(columns)
    options = {**CSV_OPTIONS, **options}
    if str(options.pop(QUOTED_BREAKS, "false")).lower() == "true":
        return read_records(spark, path, columns, csv_schema(columns), **options)
    scan = spark.read.schema(csv_schema(columns)).options(**options).csv(path)
    return with_file_order(scan)


def csv_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*columns, BAD_RECORD)])


def with_file_order(scan: DataFrame) -> DataFrame:
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def file_order(df: DataFrame) -> list[str]:
    """Order columns of a CSV scan."""
    return list(FILE_ORDER)


def write_monthly(df: DataFrame, root: str) -> None:
    """Write by (year, month); months in `df` replace stored ones, other months stay.

    Rebalancing brings a month's rows together yet cuts a large month into files of the session's
    advisory partition size, so no single task ever holds a whole month. That split is adaptive
    execution's; without it a month is one task. Rows with a reject_reason have no month; they go
    into a folder of their batch, so that each run adds its own and replaces no other run's.
    """
    (
        _filed(df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*_FOLDERS)
        .parquet(root)
    )


def append_monthly(df: DataFrame, root: str) -> None:
    """Add rows to their months without touching what is stored."""
    _filed(df).write.mode("append").option("compression", "snappy").partitionBy(*_FOLDERS).parquet(root)


def _filed(df: DataFrame) -> DataFrame:
    dated = with_months(df).withColumn(_REJECTED_IN, F.lit(None).cast("string"))
    if "reject_reason" in df.columns:
        fine = F.col("reject_reason").isNull()
        dated = dated.withColumns({c: F.when(fine, F.col(c)) for c in ("year", "month")})
        if "batch_id" in df.columns:
            dated = dated.withColumn(_REJECTED_IN, F.when(~fine, F.col("batch_id")))
    return dated.hint("rebalance", F.col("year"), F.col("month"))


def read_stored(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Everything written by write_monthly, rejected rows included. A known schema of the written
    rows saves reading one from a file."""
    reader = spark.read
    if schema is not None:
        calendar = [T.StructField("year_month", T.StringType()), *_PARTITIONS, T.StructField(_REJECTED_IN, T.StringType())]
        reader = reader.schema(T.StructType([*schema.fields, *calendar]))
    df = reader.parquet(root)
    return df.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in _PARTITIONS}).drop(_REJECTED_IN)


def rejected_rows(stored: DataFrame) -> DataFrame:
    """Rows that failed an intake rule, of all runs; months are not read."""
    return stored.filter(F.col("year").isNull())


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    """The accepted transactions; a filter on year or month prunes directories."""
    return accepted_rows(read_stored(spark, root)).drop("reject_reason", "batch_id", BAD_RECORD)


def accepted_rows(stored: DataFrame) -> DataFrame:
    """Rows filed under a month; the default partition with the rejected ones is not read."""
    return stored.filter(F.col("year").isNotNull())


def read_month_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Month files written elsewhere, one Parquet file per month in year folders ('root/*/*.parquet')
    with float amounts and a counted month period; brought to the types used here."""
    df = spark.read.parquet(pattern)
    amount: Column = F.col("amount_spent").cast(MONEY)
    typed = df.withColumns({"amount_spent": amount, "age": F.col("age").cast("int")})
    return with_months(typed)


def inventory(df: DataFrame) -> DataFrame:
    """Files and rows per month of a file-backed table with transaction_date."""
    return (
        with_months(df.withColumn("_file", F.col("_metadata.file_path")))
        .groupBy("year", "month", "_file")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("row_count"))
    )
