"""Declared tables: column types as DDL, and which bronze columns may be null."""

from __future__ import annotations

from pyspark.sql import DataFrame

# table -> column -> nullable
BRONZE_COLUMNS = {
    "genomes_variants_raw": {
        "chromosome": False,
        "position": False,
        "variant_id": False,
        "reference_allele": False,
        "alternate_allele": False,
        "sample_id": False,
        "genotype": False,
        "allele_dosage": False,
        "quality": True,
        "filter_status": False,
        "info_payload": True,
    },
    "samples_metadata_raw": {
        "sample_id": False,
        "population_code": False,
        "superpopulation": False,
        "sex": False,
        "family_id": True,
    },
    "pharmgkb_clinical_annotations_raw": {
        "clinical_annotation_id": False,
        "gene_symbol": False,
        "evidence_level": False,
        "variant_or_haplotype": True,
        "drug_names": True,
        "phenotype_categories": True,
        "clinical_annotation_types": True,
        "pediatric": True,
        "annotation_text": True,
        "url": True,
    },
    "pharmgkb_var_drug_ann_raw": {
        "annotation_id": False,
        "gene_symbol": False,
        "variant_rsid": True,
        "drug_name": True,
        "pmid": True,
        "phenotype_category": True,
        "significance": True,
        "notes": True,
        "sentence": True,
        "alleles": True,
    },
    "pharmgkb_drugs_raw": {
        "pharmgkb_drug_id": False,
        "drug_name": False,
        "generic_names": True,
        "trade_names": True,
        "drug_type": True,
        "atc_identifiers": True,
        "rxnorm_identifiers": True,
    },
    "pharmgkb_genes_raw": {
        "pharmgkb_gene_id": False,
        "gene_symbol": False,
        "ensembl_id": True,
        "ncbi_gene_id": True,
        "chromosome": True,
        "chromosomal_start": True,
        "chromosomal_end": True,
    },
    "cpic_guidelines_raw": {
        "guideline_id": False,
        "gene_symbol": False,
        "drug_name": False,
        "recommendation_text": False,
        "phenotype": True,
        "activity_score": True,
        "classification_strength": True,
        "cpic_release_version": True,
    },
}

GENOTYPES = (
    "chromosome string, position bigint, variant_id string, reference_allele string, "
    "alternate_allele string, sample_id string, genotype string, allele_dosage int, "
    "quality double, filter_status string, info_payload string"
)
PANEL = (
    "sample_id string, population_code string, superpopulation string, sex string, "
    "family_id string"
)
POPULATIONS = (
    "population_code string, population_name string, superpopulation string, "
    "region string, sample_size bigint"
)
PHARMACOGENES = (
    "gene_symbol string, ensembl_id string, ncbi_gene_id string, chromosome string, "
    "chromosomal_start bigint, chromosomal_end bigint, is_in_scope boolean, "
    "scope_rationale string"
)
VARIANTS = (
    "sample_id string, variant_id string, gene_symbol string, chromosome string, "
    "position bigint, reference_allele string, alternate_allele string, genotype string, "
    "allele_dosage int, population_code string, superpopulation string"
)
CLINICAL_VARIANTS = (
    "variant_rsid string, gene_symbol string, drug_name string, phenotype_category string, "
    "evidence_level string, is_actionable boolean, annotation_summary string"
)
GUIDANCE = (
    "guideline_id string, gene_symbol string, drug_name string, phenotype string, "
    "activity_score string, recommendation_text string, classification_strength string, "
    "cpic_release_version string"
)
RECOMMENDATIONS = (
    "gene_symbol string, drug_name string, phenotype string, recommendation_text string, "
    "classification_strength string, requires_dose_change boolean, "
    "requires_alternative boolean, cpic_release_version string"
)
FREQUENCIES = (
    "variant_id string, gene_symbol string, chromosome string, position bigint, "
    "reference_allele string, alternate_allele string, population_code string, "
    "superpopulation string, allele_count bigint, total_alleles bigint, "
    "allele_frequency double, ci_lower_wilson double, ci_upper_wilson double, "
    "delta_vs_ceu double, is_actionable boolean, snapshot_date date"
)
PHENOTYPES = (
    "gene_symbol string, population_code string, superpopulation string, "
    "phenotype_category string, individual_count bigint, population_total bigint, "
    "phenotype_percentage double, ci_lower_wilson double, ci_upper_wilson double, "
    "data_source string, snapshot_date date"
)
IMPACT = (
    "drug_name string, gene_symbol string, population_code string, population_total bigint, "
    "individuals_requiring_change bigint, percentage_requiring_change double, "
    "baseline_ceu_percentage double, delta_vs_baseline double, "
    "classification_strength string, snapshot_date date"
)
RANKING = (
    "rank_position int, drug_name string, gene_symbol string, population_code string, "
    "delta_vs_baseline double, population_affected_pct double, "
    "classification_strength string, clinical_implication string, snapshot_date date"
)

# Nested guidance records as the source publishes them.
RAW_GUIDELINES = "id string, name string, genes array<string>, url string, version string"
RAW_DRUGS = "drugid string, name string"
RAW_RECOMMENDATIONS = (
    "id string, guidelineid string, drugid string, drugrecommendation string, "
    "classification string, phenotypes map<string,string>, "
    "activityscore map<string,string>, comments string"
)


def fields_of(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs; needs no running session, unlike ``StructType.fromDDL``."""
    return [tuple(field.split(" ", 1)) for field in ddl.split(", ")]


def columns_of(ddl: str) -> list[str]:
    return [name for name, _ in fields_of(ddl)]


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the declared columns, in order and typed."""
    return df.selectExpr([f"CAST({n} AS {kind}) AS {n}" for n, kind in fields_of(ddl)])


def conform_present(df: DataFrame, ddl: str) -> DataFrame:
    """The declared columns that exist, typed."""
    present = set(df.columns)
    return df.selectExpr(
        [f"CAST({n} AS {kind}) AS {n}" for n, kind in fields_of(ddl) if n in present]
    )
