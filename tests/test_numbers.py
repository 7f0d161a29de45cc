from __future__ import annotations

import math
import random

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortscope.functions.numbers import (
    decimal_units,
    equilibrium_shares,
    rounded,
    rounded_exactly,
    tenths,
    wilson,
)


def numbers():
    pick = random.Random(7)
    values = [0.0, 1.0, 0.25, 0.35, 0.75, 0.05, 2.675, 1.005, 1.015, 3.125, 99.995, 100.0]
    for n in (64, 97, 113, 200, 2000, 20000, 65536):
        values += [k / n * 100 for k in (pick.randrange(n + 1) for _ in range(2000))]
    values += [pick.random() * 100 for _ in range(2000)]
    values += [round(pick.random() * 100, 3) for _ in range(4000)]
    values += [round(pick.random() * 100, 2) for _ in range(4000)]
    return values


def test_exact_rounding_is_pythons(spark):
    values = numbers()
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    found = df.selectExpr(
        "x", f"{rounded_exactly('x', 2)} AS two", f"{rounded_exactly('x', 6)} AS six"
    ).collect()
    assert len(found) == len(values)
    assert [r.two for r in found] == [round(r.x, 2) for r in found]
    assert [r.six for r in found] == [round(r.x, 6) for r in found]


def test_one_decimal_text_is_pythons(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": numbers()}))
    found = (
        df.selectExpr("x", f"CAST({decimal_units('x', 1)} AS BIGINT) AS units")
        .selectExpr("x", f"{tenths('units')} AS text")
        .collect()
    )
    assert [r.text for r in found] == [f"{r.x:.1f}" for r in found]


def test_scaled_rounding_is_that_of_data_frames(spark):
    values = [v - 50 for v in numbers()]
    found = (
        spark.createDataFrame(pd.DataFrame({"x": values}))
        .selectExpr(f"{rounded('x', 2)} AS r")
        .toPandas()
    )
    assert list(found.r) == list(pd.Series(values).round(2))


def test_half_even_case(spark):
    row = spark.sql(f"SELECT {rounded('2 / 64 * 100', 2)} AS r").first()
    assert row.r == 3.12


def interval(spark, k, n, **options):
    return (
        spark.range(1)
        .selectExpr(f"{k}L AS k", f"{n}L AS n")
        .selectExpr(f"{wilson('k', 'n', **options)} AS w")
        .selectExpr("w.*")
        .first()
    )


def test_wilson_bounds(spark):
    zero, full = interval(spark, 0, 100), interval(spark, 100, 100)
    assert zero.lower < 1e-15 and zero.center < 0.04
    assert full.upper == 1.0 and full.lower > 0.96
    example = interval(spark, 19, 128)
    assert 0.09 < example.lower < 0.13 and 0.19 < example.upper < 0.25


def test_wilson_against_the_formula(spark):
    pairs = [(k, n) for n in (1, 7, 10, 128, 5008) for k in range(0, n + 1, max(1, n // 10))]
    df = spark.createDataFrame(pairs, "k long, n long")
    found = df.selectExpr("k", "n", f"{wilson('k', 'n')} AS w").collect()
    for r in found:
        z2 = 1.96 * 1.96
        center = (r.k + z2 / 2) / (r.n + z2)
        half = 1.96 / (r.n + z2) * math.sqrt(r.k * (r.n - r.k) / r.n + z2 / 4)
        assert r.w.center == center
        assert r.w.lower == max(0.0, center - half)
        assert r.w.upper == min(1.0, center + half)
        assert r.w.lower <= max(r.k / r.n, 1e-12) and r.w.upper >= r.k / r.n - 1e-12


@pytest.mark.parametrize(
    "k, n, message",
    [
        (0, 0, "trials must be > 0"),
        (-1, 10, "successes must be >= 0"),
        (11, 10, "cannot exceed trials"),
    ],
)
def test_wilson_rejects_impossible_counts(spark, k, n, message):
    with pytest.raises(PySparkException, match=message):
        interval(spark, k, n)
    assert interval(spark, k, n, strict=False).lower is None


def test_equilibrium_shares_add_up(spark):
    shares = equilibrium_shares("p")
    row = spark.sql("SELECT 0.031D AS p").selectExpr(*shares).first()
    assert row[0] == pytest.approx(0.938961) and row[2] == pytest.approx(0.000961)
    assert sum(row) == pytest.approx(1.0)


def test_no_python_in_the_plan(spark):
    df = spark.range(3).select(F.expr("id / 3D").alias("x"))
    plan = df.selectExpr(rounded_exactly("x", 2))._jdf.queryExecution().toString()
    assert "Python" not in plan
