from __future__ import annotations

import random

import pytest
from checks import rows

from cohortscope.operators.ranking import build_ranking
from cohortscope.schemas import RANKING, columns_of

IMPACT = (
    "drug_name string, gene_symbol string, population_code string, population_total long, "
    "individuals_requiring_change long, percentage_requiring_change double, "
    "baseline_ceu_percentage double, delta_vs_baseline double, classification_strength string, "
    "snapshot_date date"
)


def row(drug, gene, cohort, pct, delta, strength="Strong"):
    return (drug, gene, cohort, 50, 10, pct, 0.0, delta, strength, None)


def impact(spark, *extra):
    return spark.createDataFrame(
        [
            row("clopidogrel", "CYP2C19", "MXL", 20.0, 10.0),
            row("clopidogrel", "CYP2C19", "CEU", 10.0, 0.0),
            row("warfarin", "CYP2C9", "PEL", 30.0, 22.0),
            row("warfarin", "CYP2C9", "CEU", 8.0, 0.0),
            *extra,
        ],
        IMPACT,
    )


def test_ranking(spark, study):
    found = build_ranking(impact(spark), study).orderBy("rank_position").collect()
    assert [r.rank_position for r in found] == [1, 2]
    assert [r.drug_name for r in found] == ["warfarin", "clopidogrel"]
    assert found[0].clinical_implication == (
        "22.0pp higher rate of dose/therapy change vs CEU in PEL "
        "(warfarin / CYP2C9, CPIC Strong)"
    )
    assert found[0].population_affected_pct == 30.0
    assert list(found[0].asDict()) == columns_of(RANKING)


def test_every_gene_keeps_a_row(spark, study):
    assert build_ranking(impact(spark), study, top_n=1).count() == 2


def test_only_baseline_is_empty_and_null_cohorts_stay(spark, study):
    assert build_ranking(impact(spark).where("population_code = 'CEU'"), study).isEmpty()
    found = build_ranking(impact(spark, row("x", "TPMT", None, 1.0, 1.0)), study)
    assert ("x", None) in rows(found, "drug_name", "population_code")


def test_weights_and_direction(spark, study):
    df = impact(
        spark,
        row("a", "G1", "MXL", 10.0, 10.0, "Moderate"),
        row("b", "G1", "MXL", 10.0, -10.0, "Optional"),
        row("c", "G1", "MXL", 10.0, 0.0, "Strong"),
        row("d", "G1", "MXL", 10.0, 10.0, "strong"),
    )
    found = build_ranking(df, study).where("gene_symbol = 'G1'").orderBy("rank_position").collect()
    assert [r.drug_name for r in found] == ["a", "b", "d", "c"]
    assert "10.0pp lower" in found[1].clinical_implication
    assert "0.0pp lower" in found[3].clinical_implication


@pytest.mark.parametrize("top_n", [0, 1, 5, 50, 400])
def test_against_a_plain_ranking(spark, study, top_n):
    pick = random.Random(top_n)
    data = [
        row(
            f"d{pick.randrange(30)}", f"G{pick.randrange(9)}", f"C{i}",
            round(pick.random() * 100, 2), round(pick.random() * 100 - 50, 2),
            pick.choice(["Strong", "Moderate", "Optional", "other"]),
        )
        for i in range(300)
    ]
    weights = {"Strong": 1.0, "Moderate": 0.7, "Optional": 0.3}
    scored = sorted(
        data, key=lambda r: (-(abs(r[7]) * weights.get(r[8], 0.3) * r[5]), r[0], r[1], r[2], r[8])
    )
    best, rest, seen = [], [], set()
    for r in scored:
        (rest if r[1] in seen else best).append(r)
        seen.add(r[1])
    chosen = best + rest[: max(0, top_n - len(best))]
    expected = [(r[0], r[1], r[2]) for r in scored if r in chosen]
    df = spark.createDataFrame(data, IMPACT).repartition(5)
    found = build_ranking(df, study, top_n).orderBy("rank_position").collect()
    assert [(r.drug_name, r.gene_symbol, r.population_code) for r in found] == expected
    assert [r.rank_position for r in found] == list(range(1, len(expected) + 1))
    for r in found:
        assert r.clinical_implication.startswith(f"{abs(r.delta_vs_baseline):.1f}pp ")
