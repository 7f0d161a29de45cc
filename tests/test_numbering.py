"""Positions in one order: equal to a window over all rows, and no task sees them all."""

from __future__ import annotations

import pytest
from checks import rows
from pyspark.sql import functions as F

from cohortscope.operators import numbering
from cohortscope.operators.numbering import number_rows

SQL_ORDER = "score DESC NULLS LAST, name ASC, name, score, `a b`"


def order():
    return [F.desc_nulls_last("score"), F.asc("name")]


def data(spark, n):
    """A third of the rows are copies of one row, and a third share one score."""
    return spark.range(n).selectExpr(
        "CASE id % 3 WHEN 0 THEN 'copy' WHEN 1 THEN concat('n', id) ELSE concat('m', id % 50) END AS name",
        "CASE WHEN id % 3 < 2 THEN 0.5D WHEN id % 30 = 2 THEN NULL ELSE rand(3) END AS score",
        "CASE WHEN id % 3 = 0 THEN 1L ELSE id END AS `a b`",
    )


@pytest.fixture
def store(folder):
    def landed(df, name="landed"):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    return landed


@pytest.mark.parametrize("ranges", [None, 1, 37])
@pytest.mark.parametrize("block", [7, numbering.BLOCK])
def test_positions_equal_a_window(spark, store, monkeypatch, ranges, block):
    monkeypatch.setattr(numbering, "BLOCK", block)
    df = store(data(spark, 5000).repartition(6), "input")
    found = number_rows(df, order(), store, "place", ranges)
    expected = df.selectExpr("*", f"CAST(row_number() OVER (ORDER BY {SQL_ORDER}) AS BIGINT) AS place")
    assert found.columns == expected.columns
    assert rows(found, "place", "name", "score", "a b") == rows(expected, "place", "name", "score", "a b")


def test_hot_rows_do_not_make_a_large_range(spark, store, folder):
    df = store(data(spark, 30_000), "input")
    assert number_rows(df, order(), store, ranges=20).count() == 30_000
    sizes = spark.read.parquet(f"{folder}/landed").groupBy("_range").count().collect()
    assert len(sizes) == 20 and max(r["count"] for r in sizes) < 2 * 20_001 / 20


def test_nothing_and_one_row(spark, store):
    assert number_rows(data(spark, 0), order(), store).count() == 0
    assert [r.row_position for r in number_rows(data(spark, 1), order(), store).collect()] == [1]
