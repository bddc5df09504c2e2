"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrain.sources.scratch import scratch_base

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(*columns: str) -> Column:
    """128 bits that tell rows apart by these columns' values, nulls included. Rows that agree in
    all of them are one row to the operators."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"}))


def cut(frame: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared checkpoint folder, so that a lost executor
    takes nothing with it and later steps don't compute it again."""
    spark = frame.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_base(spark))
    return frame.checkpoint()


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def any_of(words: tuple[str, ...]) -> str:
    """A pattern that matches any of the words as plain text."""
    return "|".join(re.escape(w) for w in words)


def ship(module: str) -> None:
    """Functions of this module go to Python workers by value, so that executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
