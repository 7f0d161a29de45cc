from __future__ import annotations

from dataclasses import replace

import pytest
from checks import one, rows

from cohortscope.operators.phenotypes import build_phenotypes, category, individual_dosage

FACTS = (
    "sample_id string, variant_id string, gene_symbol string, allele_dosage int, "
    "population_code string, superpopulation string"
)
COHORTS = "population_code string, sample_size long, population_name string, region string"


def people(spark, gene, variant, dosages):
    return [
        (f"{cohort}{i}", variant, gene, d, cohort, "X")
        for cohort, values in dosages.items()
        for i, d in enumerate(values)
    ]


def distribution(spark, study, facts, cohorts):
    df = spark.createDataFrame(facts, FACTS)
    populations = spark.createDataFrame([(c, n, c, "R") for c, n in cohorts], COHORTS)
    return build_phenotypes(individual_dosage(df, study), populations, study)


@pytest.mark.parametrize(
    "gene, expected",
    [
        ("CYP2C19", ["Normal Metabolizer", "Intermediate Metabolizer", "Poor Metabolizer"]),
        ("UGT1A9", ["Normal Metabolizer", "Intermediate Metabolizer", "Poor Metabolizer"]),
        ("CYP3A5", ["Normal Metabolizer", "Intermediate Metabolizer", "Poor Metabolizer"]),
        ("IFNL3", ["Favorable Genotype", "Intermediate Genotype", "Unfavorable Genotype"]),
        ("G6PD", ["Normal", "Deficient", "Deficient"]),
        ("VKORC1", ["Normal Sensitivity", "Intermediate Sensitivity", "High Sensitivity"]),
        ("SLCO1B1", ["Normal Function", "Decreased Function", "Poor Function"]),
    ],
)
def test_categories(spark, study, gene, expected):
    df = spark.createDataFrame([(gene, d) for d in (0, 1, 2, 3, 5, -1)], "g string, d long")
    found = [r[0] for r in df.selectExpr(category("d", "g", study)).collect()]
    assert found == [*expected, expected[2], expected[2], "Indeterminate"]


def test_distribution(spark, study):
    facts = people(spark, "CYP2C19", "chr10:96521657", {"MXL": [0, 2, 1], "CEU": [1, 2, 0]})
    found = distribution(spark, study, facts, [("MXL", 3), ("CEU", 3)])
    poor = one(found, "population_code = 'MXL' AND phenotype_category = 'Poor Metabolizer'")
    assert (poor.individual_count, poor.population_total, poor.phenotype_percentage) == (1, 3, 33.33)
    assert poor.ci_lower_wilson < 1 / 3 < poor.ci_upper_wilson
    assert poor.data_source == "vcf_1000G_phase3" and found.count() == 6


def test_key_variants_add_up_per_person_and_others_are_ignored(spark, study):
    facts = [
        ("S1", "chr10:96521657", "CYP2C19", 1, "MXL", "AMR"),
        ("S1", "chr10:96540410", "CYP2C19", 1, "MXL", "AMR"),
        ("S1", "chr10:96741053", "CYP2C19", 2, "MXL", "AMR"),
        ("S2", "chr10:1", "CYP2C19", 2, "MXL", "AMR"),
        ("S3", "chr10:96521657", "CYP2C19", None, "MXL", "AMR"),
        (None, "chr10:96521657", "CYP2C19", 2, "MXL", "AMR"),
    ]
    df = individual_dosage(spark.createDataFrame(facts, FACTS), study)
    assert rows(df, "sample_id", "total_dosage") == [("S1", 2), ("S3", 0)]


def test_inverted_gene(spark, study):
    facts = people(spark, "CYP3A5", "chr7:99270539", {"YRI": [2, 1, 0]})
    found = distribution(spark, study, facts, [("YRI", 3)])
    assert rows(found, "phenotype_category", "individual_count") == [
        ("Intermediate Metabolizer", 1), ("Normal Metabolizer", 1), ("Poor Metabolizer", 1),
    ]
    only = distribution(spark, study, facts[:1], [("YRI", 1)])
    assert rows(only, "phenotype_category") == [("Normal Metabolizer",)]


def test_unlisted_cohort_uses_the_observed_size_and_empty_cohorts_are_skipped(spark, study):
    facts = people(spark, "TPMT", "chr6:18131419", {"MXL": [0, 0], "PEL": [0], "CEU": [1]})
    found = distribution(spark, study, facts, [("PEL", 0), ("CEU", 50)])
    assert rows(found, "population_code", "population_total", "phenotype_percentage") == [
        ("CEU", 50, 2.0), ("MXL", 2, 100.0),
    ]


def test_literature_replaces_one_cohort(spark, study):
    facts = people(spark, "NUDT15", "chr13:48605878", {"PUR": [0] * 4, "CEU": [0] * 2})
    found = distribution(spark, study, facts, [("PUR", 104), ("CEU", 2)])
    assert rows(
        found.where("population_code = 'PUR'"),
        "phenotype_category", "individual_count", "phenotype_percentage", "data_source",
    ) == [
        ("Intermediate Metabolizer", 6, 6.01, "literature_1000G_gnomAD"),
        ("Normal Metabolizer", 98, 93.9, "literature_1000G_gnomAD"),
    ]
    assert one(found, "population_code = 'CEU'").data_source == "vcf_1000G_phase3"


def test_literature_needs_the_gene_and_the_cohort(spark, study):
    other = people(spark, "TPMT", "chr6:18131419", {"PUR": [0]})
    assert rows(distribution(spark, study, other, [("PUR", 104)]), "gene_symbol") == [("TPMT",)]
    facts = people(spark, "NUDT15", "chr13:48605878", {"PUR": [0], "CEU": [0]})
    unknown = distribution(spark, study, facts, [("CEU", 1)])
    assert {r[0] for r in rows(unknown, "data_source")} == {"vcf_1000G_phase3"}


def test_literature_fills_in_when_only_other_cohorts_were_observed(spark, study):
    facts = people(spark, "NUDT15", "chr13:48605878", {"CEU": [0]})
    found = distribution(spark, study, facts, [("PUR", 104), ("CEU", 1)])
    assert found.where("population_code = 'PUR'").count() == 2
    none = distribution(spark, replace(study, literature=()), facts, [("PUR", 104), ("CEU", 1)])
    assert none.count() == 1
