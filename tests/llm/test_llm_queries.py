"""The registered queries: SQL where there is some, and the pipeline stage by stage."""

from __future__ import annotations

import re

import brute
import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from cohortscope.llm.oracle import ORACLE_SQL
from cohortscope.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_all_are_registered():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries() and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equal_to_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE_SQL[name])
    named = [d[0] for d in cursor.description]
    columns = sorted(named)
    assert columns == sorted(found.columns)
    expected = sorted(repr([r[named.index(c)] for c in columns]) for r in cursor.fetchall())
    assert sorted(repr([r[c] for c in columns]) for r in found.collect()) == expected and expected


@pytest.mark.parametrize("name", ["op4_source_mixing", "op7_benchmark_templates"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs
    after = {}
    from cohortscope.llm.scratch import Scratch

    scratch = Scratch(spark, "test")
    for name, stage in corpus_pipeline.STAGES:
        after[name] = scratch.store(stage(spark, before, SF_DIR), "stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after[name].columns == columns
            before = after[name]
    rows = {name: {r.doc_id: r for r in df.collect()} for name, df in after.items()}
    good, exact, near, clean, mixed = rows.values()
    assert 0 < len(clean) <= len(near) <= len(exact) <= len(good) <= docs.count()
    kept = {r[0] for r in brute.exact_dedup([(d, r.text) for d, r in good.items()], max) if r[3]}
    assert set(exact) == kept
    classes = brute.similar([(d, r.text) for d, r in exact.items()])
    assert set(near) == {c for _, c, _, _ in classes}
    items = [r.text.split() for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaked = {d for d, r in near.items() if any(" ".join(i) in " ".join(r.text.split()) for i in items)}
    assert leaked and set(clean) == set(near) - leaked
    assert set(mixed) == set(clean)
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(mixed)
