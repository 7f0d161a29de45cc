from __future__ import annotations

import pytest
from checks import rows

from cohortscope.operators import quality as q

VARIANT = {
    "chromosome": "chr10", "position": 1, "variant_id": "v", "reference_allele": "A",
    "alternate_allele": "G", "sample_id": "S", "genotype": "0|1", "allele_dosage": 1,
    "quality": 1.0, "filter_status": "PASS", "info_payload": None,
}
DDL = (
    "chromosome string, position long, variant_id string, reference_allele string, "
    "alternate_allele string, sample_id string, genotype string, allele_dosage int, "
    "quality double, filter_status string, info_payload string"
)


def table(spark, *changes):
    return spark.createDataFrame([tuple({**VARIANT, **c}.values()) for c in changes], DDL)


def test_valid_rows_pass(spark):
    q.validate(table(spark, {}, {"quality": None}), "genomes_variants_raw")
    q.validate(table(spark, {}).where("FALSE"), "genomes_variants_raw")
    q.validate(spark.range(1), "not_a_declared_table")


def test_missing_columns_are_all_named(spark):
    df = table(spark, {}).drop("sample_id", "genotype")
    with pytest.raises(q.DataQualityError, match=r"missing required columns.*genotype.*sample_id"):
        q.validate(df, "genomes_variants_raw")


def test_null_columns_are_all_named_with_counts(spark):
    df = table(spark, {}, {"sample_id": None}, {"sample_id": None, "genotype": None})
    with pytest.raises(q.DataQualityError, match=r"'genotype': 1 null value.*'sample_id': 2 null"):
        q.validate(df, "genomes_variants_raw")
    assert rows(q.violations(df, "genomes_variants_raw"), "column_name", "null_count") == [
        ("genotype", 1), ("sample_id", 2),
    ]


@pytest.mark.parametrize(
    "name, required, nullable",
    [
        ("samples_metadata_raw", ["sample_id", "population_code", "superpopulation", "sex"],
         ["family_id"]),
        ("cpic_guidelines_raw",
         ["guideline_id", "gene_symbol", "drug_name", "recommendation_text"],
         ["phenotype", "activity_score", "classification_strength", "cpic_release_version"]),
        ("pharmgkb_clinical_annotations_raw",
         ["clinical_annotation_id", "gene_symbol", "evidence_level"],
         ["variant_or_haplotype", "drug_names", "phenotype_categories",
          "clinical_annotation_types", "pediatric", "annotation_text", "url"]),
        ("pharmgkb_var_drug_ann_raw", ["annotation_id", "gene_symbol"],
         ["variant_rsid", "drug_name", "pmid", "phenotype_category", "significance", "notes",
          "sentence", "alleles"]),
        ("pharmgkb_drugs_raw", ["pharmgkb_drug_id", "drug_name"],
         ["generic_names", "trade_names", "drug_type", "atc_identifiers", "rxnorm_identifiers"]),
        ("pharmgkb_genes_raw", ["pharmgkb_gene_id", "gene_symbol"],
         ["ensembl_id", "ncbi_gene_id", "chromosome", "chromosomal_start", "chromosomal_end"]),
    ],
)
def test_declared_tables(spark, name, required, nullable):
    columns = required + nullable
    ddl = ", ".join(f"{c} string" for c in columns)
    q.validate(spark.createDataFrame([tuple("x" for _ in required) + (None,) * len(nullable)], ddl), name)
    for column in required:
        with pytest.raises(q.DataQualityError, match="missing required columns"):
            q.validate(spark.createDataFrame([("x",) * len(columns)], ddl).drop(column), name)
    bad = spark.createDataFrame([(None,) * len(columns)], ddl)
    with pytest.raises(q.DataQualityError) as caught:
        q.validate(bad, name)
    assert all(f"'{c}'" in str(caught.value) for c in required)
    assert not any(f"'{c}': 1" in str(caught.value) for c in nullable)


def test_gene_scope(spark, study):
    q.assert_in_scope("CYP2C19", study)
    with pytest.raises(q.OutOfScopeGeneError, match="explicitly excluded"):
        q.assert_in_scope("CYP2D6", study)
    with pytest.raises(q.OutOfScopeGeneError, match="not in the scope"):
        q.assert_in_scope("BRCA1", study)
    df = spark.createDataFrame([("CYP2C19",), ("CYP2D6",), ("BRCA1",)], "gene_symbol string")
    assert rows(q.scope_status(df, study), "gene_symbol", "scope_status") == [
        ("BRCA1", "unknown"), ("CYP2C19", "in_scope"), ("CYP2D6", "excluded"),
    ]


def test_row_gate(spark):
    tables = {"a": spark.range(10), "b": spark.range(9)}
    least = {"a": 10, "b": 10}
    assert rows(q.row_gate(tables, least)) == [("a", 10, 10, True), ("b", 9, 10, False)]
    with pytest.raises(q.DataQualityError, match="b: 9 rows < 10"):
        q.require_rows(tables, least)
    q.require_rows({"a": tables["a"]}, least)
