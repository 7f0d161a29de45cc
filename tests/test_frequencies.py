from __future__ import annotations

import pytest
from checks import one, rows
from pyspark.errors import PySparkException

from cohortscope.operators.frequencies import build_allele_frequencies, top_variants_per_gene

FACTS = (
    "sample_id string, variant_id string, gene_symbol string, chromosome string, position long, "
    "reference_allele string, alternate_allele string, allele_dosage int, "
    "population_code string, superpopulation string, genotype string"
)
FLAGS = "variant_rsid string, is_actionable boolean"


def fact(sample, cohort, dosage, variant="chr10:1", alt="A", genotype="0|1"):
    return (sample, variant, "CYP2C19", "chr10", 1, "G", alt, dosage, cohort, "X", genotype)


def facts(spark, *rows_):
    return spark.createDataFrame(list(rows_), FACTS)


def example(spark):
    return facts(
        spark, fact("M1", "MXL", 2), fact("M2", "MXL", 1), fact("C1", "CEU", 0), fact("C2", "CEU", 1)
    )


def flags(spark, *rows_):
    return spark.createDataFrame(list(rows_), FLAGS)


def test_frequencies_and_delta(spark, study):
    df = build_allele_frequencies(example(spark), flags(spark, ("chr10:1", True)), study)
    mxl, ceu = one(df, "population_code = 'MXL'"), one(df, "population_code = 'CEU'")
    assert (mxl.allele_count, mxl.total_alleles, mxl.allele_frequency) == (3, 4, 0.75)
    assert (ceu.allele_frequency, ceu.delta_vs_ceu, mxl.delta_vs_ceu) == (0.25, 0.0, 0.5)
    assert mxl.ci_lower_wilson < 0.75 < mxl.ci_upper_wilson
    assert mxl.is_actionable and mxl.snapshot_date == study.snapshot_date


def test_flags_need_a_true_flag_on_the_same_id(spark, study):
    df = build_allele_frequencies(
        example(spark), flags(spark, ("rs1", True), ("chr10:1", None), ("chr10:1", False)), study
    )
    assert rows(df, "is_actionable") == [(False,), (False,)]


def test_missing_baseline_leaves_delta_null(spark, study):
    df = build_allele_frequencies(facts(spark, fact("M1", "MXL", 1)), flags(spark), study)
    assert rows(df, "delta_vs_ceu") == [(None,)]


def test_samples_count_once_and_null_keys_drop(spark, study):
    df = facts(spark, fact("M1", "MXL", 1), fact("M1", "MXL", 1), fact("M2", None, 2))
    found = build_allele_frequencies(df, flags(spark), study)
    assert rows(found, "allele_count", "total_alleles") == [(2, 2)]


def test_two_alleles_with_one_id_fan_out(spark, study):
    """The comparison goes by variant id alone, so each row meets both baseline rows."""
    df = facts(
        spark,
        fact("C1", "CEU", 0), fact("C2", "CEU", 1, alt="T"), fact("M1", "MXL", 2),
    )
    found = build_allele_frequencies(df, flags(spark), study)
    assert found.count() == 6
    assert rows(found.where("population_code = 'MXL'"), "delta_vs_ceu") == [(0.5,), (1.0,)]


def test_options(spark, study):
    haploid = facts(spark, fact("M1", "MXL", 1, genotype="1"), fact("M2", "MXL", 1, genotype="0/1"))
    total = build_allele_frequencies(haploid, flags(spark), study, hemizygous=True)
    assert rows(total, "allele_count", "total_alleles") == [(2, 3)]
    common = build_allele_frequencies(example(spark), flags(spark), study, min_maf=0.25)
    assert common.isEmpty()
    single = build_allele_frequencies(example(spark), flags(spark), study, single_calls=True)
    assert rows(single) == rows(build_allele_frequencies(example(spark), flags(spark), study))


def test_impossible_counts_fail(spark, study):
    df = facts(spark, fact("M1", "MXL", 3))
    with pytest.raises(PySparkException, match="cannot exceed trials"):
        build_allele_frequencies(df, flags(spark), study).collect()


def test_columns_that_are_absent_are_left_out(spark, study):
    narrow = example(spark).drop("reference_allele", "alternate_allele", "position")
    found = build_allele_frequencies(narrow, flags(spark), study)
    assert "position" not in found.columns and found.count() == 2


def test_empty_input_keeps_the_columns(spark, study):
    found = build_allele_frequencies(facts(spark, fact("M", "MXL", 0)).where("FALSE"), flags(spark), study)
    assert found.isEmpty() and "delta_vs_ceu" in found.columns


def test_top_variants(spark, study):
    df = facts(
        spark,
        *[fact(f"C{v}", "CEU", 0, variant=f"v{v}") for v in range(4)],
        *[fact(f"M{v}", "MXL", v % 3, variant=f"v{v}") for v in range(4)],
    )
    found = top_variants_per_gene(build_allele_frequencies(df, flags(spark), study), 2)
    assert {r[0] for r in rows(found, "variant_id")} == {"v1", "v2"}
    assert found.count() == 4
