from __future__ import annotations

import pytest
from checks import one, rows

from cohortscope.operators.impact import (
    STRICT_BASELINE_KEYS,
    build_drug_impact,
    build_joint_impact,
)
from cohortscope.operators.phenotypes import individual_dosage
from cohortscope.schemas import IMPACT, columns_of

PHENOTYPES = (
    "gene_symbol string, population_code string, phenotype_category string, "
    "individual_count long, population_total long"
)
RECS = (
    "gene_symbol string, drug_name string, phenotype string, classification_strength string, "
    "requires_dose_change boolean, requires_alternative boolean"
)
POOR, NORMAL = "Poor Metabolizer", "Normal Metabolizer"


def phenotypes(spark):
    return spark.createDataFrame(
        [
            ("CYP2C19", "MXL", POOR, 10, 50), ("CYP2C19", "MXL", NORMAL, 40, 50),
            ("CYP2C19", "CEU", POOR, 5, 50), ("CYP2C19", "CEU", NORMAL, 45, 50),
        ],
        PHENOTYPES,
    )


def recs(spark, *extra):
    return spark.createDataFrame(
        [
            ("CYP2C19", " Clopidogrel ", POOR, "Strong", False, True),
            ("CYP2C19", "clopidogrel", NORMAL, "Strong", False, False),
            *extra,
        ],
        RECS,
    )


def test_impact(spark, study):
    df = build_drug_impact(phenotypes(spark), recs(spark), study)
    mxl, ceu = one(df, "population_code = 'MXL'"), one(df, "population_code = 'CEU'")
    assert df.count() == 2 and df.columns == columns_of(IMPACT)
    assert (mxl.drug_name, mxl.individuals_requiring_change) == ("clopidogrel", 10)
    assert (mxl.percentage_requiring_change, mxl.baseline_ceu_percentage) == (20.0, 10.0)
    assert (mxl.delta_vs_baseline, ceu.delta_vs_baseline) == (10.0, 0.0)


def test_several_strengths_in_the_baseline_fan_out(spark, study):
    two = recs(spark, ("CYP2C19", "clopidogrel", NORMAL, "Moderate", True, False))
    df = build_drug_impact(phenotypes(spark), two, study)
    assert rows(
        df.where("population_code = 'MXL'"),
        "classification_strength", "baseline_ceu_percentage", "delta_vs_baseline",
    ) == [
        ("Moderate", 10.0, 70.0), ("Moderate", 90.0, -10.0),
        ("Strong", 10.0, 10.0), ("Strong", 90.0, -70.0),
    ]
    strict = build_drug_impact(phenotypes(spark), two, study, STRICT_BASELINE_KEYS)
    assert rows(strict.where("population_code = 'MXL'"), "delta_vs_baseline") == [(-10.0,), (10.0,)]


def test_missing_baseline_counts_as_zero(spark, study):
    df = build_drug_impact(
        phenotypes(spark).where("population_code <> 'CEU'"), recs(spark), study
    )
    assert rows(df, "baseline_ceu_percentage", "delta_vs_baseline") == [(0.0, 20.0)]


def test_null_strength_drops_and_empty_inputs_are_empty(spark, study):
    nothing = recs(spark, ("CYP2C19", "x", POOR, None, True, True))
    assert rows(build_drug_impact(phenotypes(spark), nothing, study), "drug_name") == [
        ("clopidogrel",), ("clopidogrel",),
    ]
    empty = build_drug_impact(phenotypes(spark).where("FALSE"), recs(spark), study)
    assert empty.isEmpty() and empty.columns == columns_of(IMPACT)
    assert build_drug_impact(phenotypes(spark), recs(spark).where("FALSE"), study).isEmpty()


FACTS = (
    "sample_id string, population_code string, superpopulation string, gene_symbol string, "
    "variant_id string, allele_dosage int"
)
SAMPLES = [
    ("CEU_1", "CEU", 0, 0), ("CEU_2", "CEU", 2, 0), ("PEL_1", "PEL", 2, 2), ("PEL_2", "PEL", 1, 1),
]


def joint(spark, study, sizes, keep=lambda row: True):
    facts = [
        (s, c, "X", gene, study.key_variants[gene][0], dosage)
        for s, c, first, second in SAMPLES
        for gene, dosage in (("VKORC1", first), ("CYP2C9", second))
    ]
    df = spark.createDataFrame([f for f in facts if keep(f)], FACTS)
    populations = spark.createDataFrame(sizes, "population_code string, sample_size long")
    return build_joint_impact(individual_dosage(df, study, study.joint.genes), populations, study)


def test_joint_impact(spark, study):
    df = joint(spark, study, [("CEU", 2), ("PEL", 2)])
    ceu, pel = one(df, "population_code = 'CEU'"), one(df, "population_code = 'PEL'")
    assert df.columns == columns_of(IMPACT)
    assert (ceu.drug_name, ceu.gene_symbol) == ("warfarin", "VKORC1+CYP2C9")
    assert (ceu.individuals_requiring_change, ceu.percentage_requiring_change) == (1, 50.0)
    assert (pel.individuals_requiring_change, pel.percentage_requiring_change) == (2, 100.0)
    assert (pel.delta_vs_baseline, ceu.delta_vs_baseline) == (50.0, 0.0)
    assert (pel.baseline_ceu_percentage, pel.classification_strength) == (50.0, "Strong")


def test_joint_denominator_is_the_recorded_size(spark, study):
    df = joint(spark, study, [("CEU", 10), ("PEL", 10)])
    assert one(df, "population_code = 'PEL'").percentage_requiring_change == 20.0
    skipped = joint(spark, study, [("CEU", 2), ("PEL", 0)])
    assert rows(skipped, "population_code") == [("CEU",)]


@pytest.mark.parametrize(
    "keep",
    [
        lambda f: f[3] == "VKORC1",
        lambda f: f[3] == "CYP2C9",
        lambda f: (f[3] == "VKORC1") == f[0].endswith("1"),
    ],
)
def test_joint_needs_both_genes_in_one_person(spark, study, keep):
    assert joint(spark, study, [("CEU", 2), ("PEL", 2)], keep).isEmpty()


def test_joint_doses(study):
    levels = {
        (a, b): study.joint.doses.get((a, b), "standard")
        for a in study.gene_categories["VKORC1"]
        for b in study.default_categories
    }
    assert sum(level == "low" for level in levels.values()) == 5
    assert levels["Normal Sensitivity", "Poor Metabolizer"] == "standard"
