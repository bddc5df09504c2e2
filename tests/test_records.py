"""CSV records read by many tasks, against Spark's reader of one task per file."""

import os
import random

import pytest
from pyspark.sql import functions as F

from spendgrain.plans.ingestion import run_ingestion
from spendgrain.sources.files import BAD_RECORD, read_csv, read_raw
from spendgrain.sources.records import ENDS_INSIDE, ENDS_OUTSIDE, LEAVES, TURNS, join_lines, line_step, scan_lines
from tests.test_golden import HEADER

WIDTH = len(HEADER.split(","))


@pytest.fixture
def small_splits(spark):
    """A few lines per task."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def cell(r):
    if r.random() < 0.6:
        return r.choice(["a", "", "x y", '5" pipe', 'b "q" c', "é"])
    return '"' + "".join(r.choice(["a", ",", '""', "\n", "\n\n", "z ", '""""']) for _ in range(r.choice([2, 8, 90]))) + '"'


def put(folder, name, lines, end="\n"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(end.join([HEADER, *lines]), newline="")


def read(frame):
    rows = frame.orderBy("_file", "_block", "_row").collect()
    return [(os.path.basename(x["_file"]), *[v and v.replace("\r\n", "\n") for v in tuple(x)[:-3]]) for x in rows]


@pytest.mark.parametrize("seed", range(4))
def test_same_records_as_one_task_per_file(spark, small_splits, tmp_path, seed):
    r = random.Random(seed)
    for name in "ab":
        rows = [",".join(cell(r) for _ in range(WIDTH)) for _ in range(50)]
        put(tmp_path / "in", f"{name}.csv", rows + r.choice([[], [""]]), r.choice(["\n", "\r\n"]))
    path = str(tmp_path / "in")
    found = read(read_csv(spark, path, quotedBreaks="true"))
    assert found == read(read_csv(spark, path, multiLine="true"))
    assert len(found) == 100 and all(x[-1] is None for x in found)
    lines = scan_lines(spark, path)
    assert lines.rdd.getNumPartitions() > 4
    # Some records lie in several splits.
    crossing = join_lines(lines).where(F.length("record") > 150).count()
    assert crossing > 0


def test_broken_blank_and_endless_records(spark, small_splits, tmp_path):
    fine = ",".join(["v"] * WIDTH)
    put(tmp_path / "in", "a.csv", ["", fine, "   ", "too,few", fine, fine[:-1] + '"never\nends', "x" * 400])
    found = read(read_csv(spark, str(tmp_path / "in"), quotedBreaks="true"))
    assert [x[1] for x in found] == ["v", "too", "v", "v"]
    assert [x[-1] for x in found][:3] == [None, "too,few", None]
    assert found[3][-2].startswith("never\nends\n") or found[3][-1] is not None
    (tmp_path / "in" / "empty.csv").write_text("")
    assert read_csv(spark, str(tmp_path / "in" / "a.csv"), quotedBreaks="false").count() > 4


def test_a_header_that_differs(spark, tmp_path):
    fine = ",".join(["v"] * WIDTH)
    put(tmp_path / "in", "a.csv", [fine])
    (tmp_path / "in" / "b.csv").write_text("﻿" + HEADER + "\r\n" + fine + "\n", encoding="utf-8")
    assert read_csv(spark, str(tmp_path / "in"), quotedBreaks="true").count() == 2
    (tmp_path / "in" / "c.csv").write_text(HEADER.replace("Gender", "Sex") + "\n" + fine)
    with pytest.raises(Exception, match="CSV header differs"):
        read_csv(spark, str(tmp_path / "in"), quotedBreaks="true").collect()


@pytest.mark.parametrize(
    ("line", "step"),
    [
        ("a,b", LEAVES),
        ('a,"b",c', ENDS_OUTSIDE),  # from inside: the quote before b closes, and the one after it is stray
        ('a,"b', TURNS),
        ('a,""', LEAVES),
        ('b",c', ENDS_OUTSIDE),
        ('b",c,"d', ENDS_INSIDE),
        ('5" pipe,x', ENDS_OUTSIDE),
        ('""', LEAVES),
        ('"', TURNS),
        ('x,"a,""b"",c', TURNS),
    ],
)
def test_what_a_line_does(spark, line, step):
    def ends(text, inside):
        """Character by character."""
        start, quoted, i = not inside, inside, 0
        while i < len(text):
            c = text[i]
            if quoted:
                if c == '"' and text[i + 1 : i + 2] == '"':
                    i += 1
                elif c == '"':
                    quoted = False
            elif c == '"' and start:
                quoted = True
            start = not quoted and c == ","
            i += 1
        return quoted

    after = ends(line, False), ends(line, True)
    expected = {(False, True): LEAVES, (True, False): TURNS, (False, False): ENDS_OUTSIDE, (True, True): ENDS_INSIDE}[after]
    assert expected == step
    assert spark.createDataFrame([(line,)], "line string").select(line_step("line")).first()[0] == step


def test_ingestion_with_line_breaks(spark, tmp_path):
    rows = [f'2018-0{1 + i % 9}-05,T{i},Male,30,Single,"New\nYork",Basic,Employees,Card,No,"{i}.50\n"' for i in range(20)]
    put(tmp_path / "in", "a.csv", rows)
    done = run_ingestion(spark, str(tmp_path / "in"), str(tmp_path / "store"), csv_options={"quotedBreaks": "true"})
    assert done["rejected"][BAD_RECORD] == 0
    stored = read_raw(spark, str(tmp_path / "store" / "raw"))
    assert {x["state_names"] for x in stored.collect()} == {"New\nYork"} and stored.count() == 20
