"""Clinical annotations of variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope import domain
from cohortscope.functions import literals
from cohortscope.functions.text import blank_if_null, cross_reference_ids, listed_names, summary
from cohortscope.operators.dedup import first_bytes, keep_first, may_be_first
from cohortscope.schemas import CLINICAL_VARIANTS, conform
from cohortscope.study import Study

KEYS = ("variant_rsid", "gene_symbol", "drug_name")


def build_clinical_variants(
    annotations: DataFrame,
    study: Study,
    order_by: Sequence[str] = ("clinical_annotation_id",),
) -> DataFrame:
    """One row per variant, gene and drug of the in-scope annotations."""
    present = set(annotations.columns)
    order = [c for c in order_by if c in present]

    def optional(column: str) -> str:
        return column if column in present else "CAST(NULL AS STRING)"

    wanted = ("phenotype_categories", "evidence_level", "annotation_text")
    chosen = annotations.where(f"gene_symbol IN ({literals(study.scope_genes)})")
    named = chosen.withColumn("_start", F.expr(first_bytes(order[0] if order else "NULL"))).selectExpr(
        *order,
        "variant_or_haplotype AS variant_rsid",
        "gene_symbol",
        f"posexplode({listed_names('drug_names')}) AS (_entry, drug_name)",
        "_start",
        *[c for c in wanted if c in present and c not in order],
    )
    if order:
        named = may_be_first(named, KEYS, "_start")
    listed = named.selectExpr(
        *order,
        "concat(variant_rsid, '') AS variant_rsid",  # so that a hot variant's rows are dealt anew
        *KEYS[1:],
        "_entry",
        f"{blank_if_null(optional('phenotype_categories'))} AS phenotype_category",
        "evidence_level",
        f"coalesce(evidence_level IN ({literals(domain.ACTIONABLE_EVIDENCE)}), FALSE) "
        "AS is_actionable",
        f"{summary(optional('annotation_text'))} AS annotation_summary",
    )
    return conform(keep_first(listed, KEYS, [*order, "_entry"]), CLINICAL_VARIANTS)


def with_cross_references(drugs: DataFrame, column: str = "_cross_references") -> DataFrame:
    """Replaces the cross-reference list by its ATC and RxNorm identifiers."""
    if column not in drugs.columns:
        missing = "CAST(NULL AS STRING)"
        return drugs.selectExpr(
            "*", f"{missing} AS atc_identifiers", f"{missing} AS rxnorm_identifiers"
        )
    return drugs.selectExpr(
        "*",
        f"{cross_reference_ids(column, 'ATC')} AS atc_identifiers",
        f"{cross_reference_ids(column, 'RxNorm')} AS rxnorm_identifiers",
    ).drop(column)
