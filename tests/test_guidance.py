from __future__ import annotations

from dataclasses import replace

from checks import one, rows

from cohortscope.operators.clinical import build_clinical_variants, with_cross_references
from cohortscope.operators.guidance import (
    build_recommendations,
    flatten_recommendations,
    override,
)
from cohortscope.schemas import RAW_DRUGS, RAW_GUIDELINES, RAW_RECOMMENDATIONS, RECOMMENDATIONS
from cohortscope.schemas import GUIDANCE, columns_of

ANNOTATIONS = (
    "clinical_annotation_id string, variant_or_haplotype string, gene_symbol string, "
    "drug_names string, phenotype_categories string, evidence_level string, "
    "annotation_text string"
)


def test_clinical_variants(spark, study):
    df = spark.createDataFrame(
        [
            ("CA1", "rs4244285", "CYP2C19", "Clopidogrel; omeprazole,clopidogrel", "Metabolism",
             "1A", "x" * 600),
            ("CA2", "CYP2C19*2", "CYP2C19", "omeprazole", None, "2B", None),
            ("CA3", "rs1057910", "CYP2C9", "warfarin", "Dosage", "1B", "Text 3"),
            ("CA4", "rs1057910", "CYP2C9", "Warfarin ", "Other", "4", "later"),
            ("CA5", "rs1", "CYP2C9", None, "Dosage", None, ""),
            ("CA6", "rs2", "CYP2D6", "codeine", "Dosage", "1A", ""),
        ],
        ANNOTATIONS,
    )
    found = build_clinical_variants(df, study)
    assert rows(found, "variant_rsid", "drug_name", "evidence_level", "is_actionable") == [
        ("CYP2C19*2", "omeprazole", "2B", False),
        ("rs1", "", None, False),
        ("rs1057910", "warfarin", "1B", True),
        ("rs4244285", "clopidogrel", "1A", True),
        ("rs4244285", "omeprazole", "1A", True),
    ]
    assert len(one(found, "drug_name = 'clopidogrel'").annotation_summary) == 500
    assert one(found, "variant_rsid = 'CYP2C19*2'").phenotype_category == ""
    narrow = df.drop("annotation_text", "phenotype_categories")
    assert build_clinical_variants(narrow, study).where("annotation_summary <> ''").isEmpty()
    assert build_clinical_variants(df.where("FALSE"), study).isEmpty()


def test_cross_reference_columns(spark):
    df = spark.createDataFrame([("PA1", "ATC:B01,RxNorm:3")], "id string, _cross_references string")
    assert rows(with_cross_references(df)) == [("PA1", "B01", "3")]
    assert rows(with_cross_references(df.select("id"))) == [("PA1", None, None)]


def guidance_row(gene="CYP2C19", drug="clopidogrel", phenotype="Poor Metabolizer",
                 text="Avoid use.", strength="Strong", gid="G:1"):
    return (gid, gene, drug, phenotype, "0.0", text, strength, "v2")


def test_recommendations(spark, study):
    df = spark.createDataFrame(
        [
            guidance_row(),
            guidance_row(drug=" CLOPIDOGREL ", text="Reduce dose.", gid="G:2"),
            guidance_row(phenotype="Normal Metabolizer", text="Standard dosing."),
            guidance_row(phenotype=None, text="Standard dosing."),
            guidance_row(gene="CYP2D6", drug="codeine"),
            guidance_row(gene="G6PD", drug="aspirin", phenotype="Normal",
                         text="No reason to avoid"),
        ],
        GUIDANCE,
    )
    found = build_recommendations(df, study)
    assert found.columns == columns_of(RECOMMENDATIONS)
    assert found.count() == 3 + 52
    poor = one(found, "drug_name = 'clopidogrel' AND phenotype = 'Poor Metabolizer'")
    assert (poor.requires_dose_change, poor.requires_alternative) == (False, True)
    aspirin = one(found, "gene_symbol = 'G6PD' AND drug_name = 'aspirin'")
    assert not aspirin.requires_alternative and aspirin.cpic_release_version == "v1.0-2022"
    assert found.where("gene_symbol = 'CYP2D6'").isEmpty()


def test_no_source_row_means_no_curated_rows(spark, study):
    other = spark.createDataFrame([guidance_row(gene="CYP2D6")], GUIDANCE)
    assert build_recommendations(other, study).isEmpty()
    some = spark.createDataFrame([guidance_row()], GUIDANCE)
    assert build_recommendations(some, replace(study, curated=study.curated[:1])).count() == 2


def test_override_matches_null_keys(spark):
    ddl = "gene_symbol string, drug_name string, phenotype string, x int"
    left = spark.createDataFrame([("G", "d", None, 1), ("G", "d", "p", 2)], ddl)
    right = spark.createDataFrame([("G", "d", None, 3)], ddl)
    assert rows(override(left, right), "phenotype", "x") == [(None, 3), ("p", 2)]


GUIDELINES = [
    ("A", "n", ["CYP2C19"], "u", "3"),
    ("B", "n", ["CYP2C19", "cyp2d6"], "u", None),
    ("C", "n", [], "u", "1"),
    ("D", "n", None, "u", "1"),
]


def rec(rid, guideline, drug="D1", phenotypes=None, scores=None):
    return (rid, guideline, drug, "text", "Strong", phenotypes, scores, "")


def flatten(spark, *records):
    return flatten_recommendations(
        spark.createDataFrame(list(records), RAW_RECOMMENDATIONS),
        spark.createDataFrame(GUIDELINES, RAW_GUIDELINES),
        spark.createDataFrame([("D1", "clopidogrel"), ("D2", ""), ("", "x")], RAW_DRUGS),
    )


def test_flatten(spark):
    found = flatten(
        spark,
        rec("1", "A", phenotypes={"CYP2C19": "Poor"}, scores={"CYP2C19": "0.0"}),
        rec("2", "unknown", phenotypes={"CYP2C19": "Poor"}),
        rec("3", "B", drug="D2", phenotypes={"CYP2C19": "", "CYP2D6": "Normal"}),
        rec("4", "C", drug=None, phenotypes={"X": "p", "Y": "q"}),
        rec("5", "D", phenotypes={"X": "p"}),
        rec("6", "C"),
        rec(None, None),
    )
    assert rows(
        found, "guideline_id", "gene_symbol", "drug_name", "phenotype", "activity_score",
        "cpic_release_version",
    ) == [
        ("A:1", "CYP2C19", "clopidogrel", "Poor", "0.0", "3"),
        ("B:3", "CYP2C19", "D2", "", "", ""),
        ("B:3", "cyp2d6", "D2", "Normal", "", ""),
        ("C:4", "X", "", "p", "", "1"),
        ("C:4", "Y", "", "q", "", "1"),
        ("D:5", "X", "clopidogrel", "p", "", "1"),
    ]
