"""CSV records with line breaks inside quotes, read by many tasks per file.

A file is split and read by lines. Whether a line begins inside quotes depends on everything before it, but a line
does only one of four things to that: leave it, turn it round, end outside whatever was before, or end inside.
Such steps compose, so each split is reduced to its own step, the splits of a file are put in
order (one small row each), and every line then learns its state within its split alone. Lines that end inside quotes are joined with
the next ones to a record, across splits too; records go through Spark's own CSV parser.

The lines are shuffled once, by split, so that no task holds more than a split; the reader's option multiLine
reads each file in one task instead. A quote opens only at the start of a field, as for the parser, so a stray one inside
a field does not turn the rest of the file round.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendgrain.functions.literals import sql_text

LEAVES, TURNS, ENDS_OUTSIDE, ENDS_INSIDE = range(4)
_SPLIT = ("_file", "_block")
# Reader options that are about files, not about the fields of a record.
_OF_FILES = ("header", "enforceSchema", "columnPruning", "multiLine")


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the start of their split and their order in it. Only line feeds end lines; a carriage return before one stays."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def line_step(line: str, sep: str = ",") -> Column:
    """What a line (a column's name) does to being inside quotes."""
    other = f"[^{re.escape(sep)}]*+"
    quoted = '[^"]*+(?:""[^"]*+)*+"'  # the rest of a quoted field, from behind its opening quote
    start = f"(^|{re.escape(sep)})"

    def open_at_end(text: str) -> str:
        """SQL: whether a quoted field opens in it and does not close, if it begins outside."""
        rest = f"regexp_replace({text}, {sql_text(f'{start}"{quoted}{other}')}, '$1')"
        return f"regexp_like({rest}, {sql_text(f'{start}"')})"

    closed = f"regexp_like({line}, {sql_text('^' + quoted)})"
    behind = f"regexp_replace({line}, {sql_text('^' + quoted + other)}, '')"
    from_outside, from_inside = open_at_end(line), f"(NOT {closed} OR {open_at_end(behind)})"
    return F.expr(
        f"CASE WHEN NOT contains({line}, '\"') THEN {LEAVES} "
        f"WHEN {from_outside} THEN CASE WHEN {from_inside} THEN {ENDS_INSIDE} ELSE {TURNS} END "
        f"ELSE CASE WHEN {from_inside} THEN {LEAVES} ELSE {ENDS_OUTSIDE} END END"
    )


def _running(rows: DataFrame, step: str, by: Sequence[str], order: str, name: str) -> DataFrame:
    """`name`: the step that all rows up to this one make together."""
    so_far = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turned = rows.withColumn("_turns", F.count_if(F.col(step) == TURNS).over(so_far))
    # The last row that sets the state, and the turns before it.
    setting = F.when(F.col(step) >= ENDS_OUTSIDE, F.struct((F.col(step) == ENDS_INSIDE).cast("int").alias("inside"), F.col("_turns").alias("turns")))
    last = turned.withColumn("_set", F.last(setting, ignorenulls=True).over(so_far))
    inside = (F.col("_set.inside") + F.col("_turns") - F.col("_set.turns")) % 2
    together = F.when(F.col("_set").isNull(), F.col("_turns") % 2).otherwise(inside + ENDS_OUTSIDE)
    return last.withColumn(name, together.cast("int")).drop("_turns", "_set")


def _after(step: Column, before: Column) -> Column:
    """Whether a step ends inside quotes, begun as `before` says."""
    return F.when(step == LEAVES, before).when(step == TURNS, ~before).otherwise(step == ENDS_INSIDE)


def split_starts(lines: DataFrame) -> DataFrame:
    """_file, _block and starts_inside of each split. Of lines only those that change something leave their task, without their text."""
    step = F.struct("_row", "step")
    splits = lines.groupBy(*_SPLIT).agg(F.sort_array(F.collect_list(F.when(F.col("step") != LEAVES, step))).alias("steps"))

    def made(state: Column, one: Column) -> Column:
        return F.struct(*[_after(one["step"], state[c]).alias(c) for c in ("outside", "inside")])

    # Where the split ends, begun outside and begun inside.
    ends = F.aggregate("steps", F.struct(F.lit(False).alias("outside"), F.lit(True).alias("inside")), made)
    both = splits.select(*_SPLIT, ends.alias("e")).withColumn(
        "step",
        F.when(F.col("e.outside") == F.col("e.inside"), F.when(F.col("e.inside"), ENDS_INSIDE).otherwise(ENDS_OUTSIDE))
        .when(F.col("e.outside"), TURNS)
        .otherwise(LEAVES),
    )
    reached = _running(both, "step", ["_file"], "_block", "reached")
    ended = reached.withColumn("ends_inside", _after(F.col("reached"), F.lit(False)))
    before = F.lag("ends_inside", 1, False).over(Window.partitionBy("_file").orderBy("_block"))
    return ended.select(*_SPLIT, before.alias("starts_inside"))


def join_lines(lines: DataFrame, sep: str = ",") -> DataFrame:
    """lines: line, _file, _block, _row. One row per record: its text, with line feeds where its lines met, the place of its
    first line, and whether it is the first of its file."""
    stepped = lines.withColumn("step", line_step("line", sep))
    placed = stepped.join(split_starts(stepped), list(_SPLIT))
    reached = _running(placed, "step", _SPLIT, "_row", "reached")
    ended = reached.withColumn("ends_inside", _after(F.col("reached"), F.col("starts_inside")))
    in_split = Window.partitionBy(*_SPLIT).orderBy("_row")
    begun = ended.withColumn("begins", ~F.coalesce(F.lag("ends_inside").over(in_split), F.col("starts_inside")))
    numbered = begun.withColumn("number", F.count_if("begins").over(in_split))
    # The lines of a split are together already, so this grouping moves nothing.
    parts = numbered.groupBy(*_SPLIT, "number").agg(
        F.min("_row").alias("_row"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_row", "line"))), lambda x: x["line"]), "\n").alias("record"),
        F.max_by("ends_inside", "_row").alias("open"),
    )
    first = ((F.col("_block") == 0) & (F.col("number") == 1)).alias("first")
    whole = parts.where("number > 0 AND NOT open").select("record", *_SPLIT, "_row", first)
    # Records that cross a split's end: at most two parts of a split.
    crossing = parts.where("number = 0 OR open")
    order = Window.partitionBy("_file").orderBy("_block", "_row")
    chained = crossing.withColumn("chain", F.count_if(F.col("number") > 0).over(order))
    piece = F.struct("_block", "_row", "record", "number")
    crossed = chained.groupBy("_file", "chain").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda x: x["record"]), "\n")
    joined = crossed.select(text.alias("record"), "_file", F.col("pieces")[0].alias("p")).select("record", "_file", "p._block", "p._row", "p.number")
    return whole.unionByName(joined.withColumn("first", first).drop("number"))


def read_records(spark: SparkSession, path: str, columns: Sequence[str], schema: T.StructType, **options: str) -> DataFrame:
    """The records of CSV files (UTF-8, quotes doubled inside quotes) with header `columns`, parsed with `schema`, and the place
    of each one's first line. Blank lines are no records. Fails where a file's header differs."""
    records = join_lines(scan_lines(spark, path), options.get("sep", options.get("delimiter", ",")))
    parsing = {k: str(v) for k, v in options.items() if k not in _OF_FILES}
    # With this option the parser keeps line breaks inside quotes as they are.
    parsing["multiLine"] = "true"
    names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))])
    found = records.withColumn("record", F.regexp_replace("record", "\\r$", "")).select(
        "first",
        F.from_csv("record", _ddl(schema), parsing).alias("fields"),
        F.when(F.col("first"), F.from_csv(F.regexp_replace("record", "^\ufeff", ""), _ddl(names), parsing)).alias("names"),
        F.trim("record").alias("record"),
        "_file",
        "_block",
        "_row",
    )
    expected = F.struct(*[F.lit(c).alias(f.name) for c, f in zip(columns, names.fields, strict=True)])
    differs = F.raise_error(F.concat(F.lit("CSV header differs from the first file's: "), "_file", F.lit(": "), "record"))
    data = F.when(~F.col("first"), F.col("record") != "").when(F.col("names").eqNullSafe(expected), F.lit(False)).otherwise(differs.cast("boolean"))
    return found.where(data).select("fields.*", "_file", "_block", "_row")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
