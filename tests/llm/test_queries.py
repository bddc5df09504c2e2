"""The registered queries against their SQL, and the pipeline against what each stage promises."""

import os
import re

import duckdb
import pytest

import corpus_pipeline
from spendgrain.llm import decontaminate
from spendgrain.llm.queries import LLM_ORACLE, LLM_QUERIES
from tests.test_oracle import rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_against_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        duck.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    cursor = duck.execute(LLM_ORACLE[name])
    columns = [d[0] for d in cursor.description]
    found = LLM_QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert rows(found.columns, [tuple(r) for r in found.collect()]) == rows(columns, cursor.fetchall())


@pytest.mark.parametrize("number", range(1, 14))
def test_each_operator_has_a_query(number):
    assert sum(name.startswith(f"op{number}_") for name in LLM_QUERIES) == 1


def test_pipeline(spark):
    """Benchmark passages are looked up as plain text, secrets by their format, copies by their text."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    table = decontaminate.lower_table()

    def plain(text):
        chars, _ = decontaminate.normalised([text], table)
        return "".join(map(chr, chars[:-1]))

    items = [plain(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, SF_DIR)
        if name != "source_mix":
            assert kept.columns == docs.columns
        texts = [r.text for r in kept.collect()]
        if name == "language":
            assert len(texts) == sum(any(c.isalpha() for c in r.text or "") for r in before.collect())
        elif name == "near_duplicates":
            assert len(set(texts)) == len(texts) and len(texts) > 0.6 * before.count()
        elif name == "benchmark_passages":
            clean = [r.text for r in before.collect() if not any(i in plain(r.text) for i in items)]
            assert sorted(texts) == sorted(clean)
        elif name == "secrets":
            assert len(texts) == before.count()
            assert not any(re.search(r'token = "[0-9a-f]{40}"', t) for t in texts)
        else:
            assert "shard" in kept.columns
            assert {r.doc_id for r in kept.collect()} <= {r.doc_id for r in before.collect()}
