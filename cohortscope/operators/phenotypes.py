"""Dosage per individual and the phenotype categories inferred from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope import domain
from cohortscope.functions import literal, lookup
from cohortscope.functions.genome import category_of, is_key_variant
from cohortscope.functions.numbers import (
    equilibrium_shares,
    rounded,
    rounded_exactly,
    wilson,
)
from cohortscope.operators.dimensions import literature_table
from cohortscope.schemas import PHENOTYPES, conform
from cohortscope.study import Study


def individual_dosage(
    variants: DataFrame, study: Study, genes: Sequence[str] | None = None
) -> DataFrame:
    """Alternate copies per person and gene over the gene's key variants, all genes at once."""
    chosen = {
        gene: ids for gene, ids in study.key_variants.items() if genes is None or gene in genes
    }
    return (
        variants.where(is_key_variant("gene_symbol", "variant_id", chosen))
        .where(
            "sample_id IS NOT NULL AND population_code IS NOT NULL AND superpopulation IS NOT NULL"
        )
        .groupBy("sample_id", "population_code", "superpopulation", "gene_symbol")
        .agg(F.expr("coalesce(sum(allele_dosage), 0L)").alias("total_dosage"))
    )


def nonfunctional_copies(study: Study) -> str:
    """Total dosage, turned around where the reference allele is the non-functional one."""
    ploidies = {g: 2 * len(study.key_variants[g]) for g in study.inverted_genes}
    return f"coalesce({lookup('gene_symbol', ploidies, 'NULL')} - total_dosage, total_dosage)"


def category(copies: str, gene: str, study: Study) -> str:
    return category_of(
        gene, copies, study.gene_categories, study.default_categories, domain.UNKNOWN_CATEGORY
    )


def cohort_sizes(populations: DataFrame) -> DataFrame:
    """One recorded size per cohort (the last by superpopulation if there are several)."""
    by = "superpopulation" if "superpopulation" in populations.columns else "sample_size"
    return populations.groupBy("population_code").agg(
        F.expr(f"CAST(max_by(sample_size, {by}) AS BIGINT)").alias("recorded_size")
    )


def build_phenotypes(dosages: DataFrame, populations: DataFrame, study: Study) -> DataFrame:
    """Share of each category per gene and cohort, from ``individual_dosage`` rows.

    Everything after the one aggregate over people works on at most one row per gene,
    cohort and category. Published rows stand in for a gene and cohort if the gene was
    observed at all; windows over those few rows decide that, after a single exchange by
    gene, so the facts are computed once.
    """
    counted = (
        dosages.selectExpr("*", f"{nonfunctional_copies(study)} AS _copies")
        .selectExpr("*", f"{category('_copies', 'gene_symbol', study)} AS phenotype_category")
        .groupBy("gene_symbol", "population_code", "phenotype_category")
        .agg(
            F.count(F.lit(1)).alias("individual_count"),
            F.min("superpopulation").alias("superpopulation"),
        )
    )
    # A cohort of recorded size zero is skipped, one without a record counts itself.
    candidates = (
        counted.join(cohort_sizes(populations), "population_code", "left")
        .where("recorded_size IS NULL OR recorded_size <> 0")
        .selectExpr(
            *CANDIDATE_KEYS,
            "CAST(NULL AS DOUBLE) AS _share",
            f"{literal(study.observed_source)} AS data_source",
            "FALSE AS _published",
        )
    )
    if study.literature:
        candidates = candidates.unionByName(literature_rows(populations, study))
    gene = "OVER (PARTITION BY gene_symbol)"
    cohort = "OVER (PARTITION BY gene_symbol, population_code)"
    own = "CASE WHEN NOT _published THEN {} END"
    chosen = (
        candidates.selectExpr("*", f"bool_or(NOT _published) {gene} AS _seen")
        .selectExpr(
            "*",
            f"bool_or(_published AND _seen) {cohort} AS _replaced",
            f"sum({own.format('individual_count')}) {cohort} AS _observed",
            f"min({own.format('superpopulation')}) {cohort} AS _superpopulation",
        )
        .where("CASE WHEN _published THEN _seen AND individual_count > 0 ELSE NOT _replaced END")
        .selectExpr(
            "gene_symbol",
            "population_code",
            "CASE WHEN _published THEN superpopulation ELSE _superpopulation END "
            "AS superpopulation",
            "phenotype_category",
            "individual_count",
            "coalesce(recorded_size, _observed) AS population_total",
            "coalesce(_share, individual_count / population_total) * 100D AS _percent",
            "data_source",
        )
    )
    rated = chosen.selectExpr(
        "*", f"{wilson('individual_count', 'population_total')} AS _ci"
    ).selectExpr(
        "*",
        f"{rounded_exactly('_percent', 2)} AS phenotype_percentage",
        f"{rounded('_ci.lower', 6)} AS ci_lower_wilson",
        f"{rounded('_ci.upper', 6)} AS ci_upper_wilson",
        f"DATE'{study.snapshot_date}' AS snapshot_date",
    )
    return conform(rated, PHENOTYPES)


CANDIDATE_KEYS = (
    "gene_symbol",
    "population_code",
    "superpopulation",
    "phenotype_category",
    "individual_count",
    "recorded_size",
)


def literature_rows(populations: DataFrame, study: Study) -> DataFrame:
    """Expected counts per category from published allele frequencies."""
    known = "superpopulation" in populations.columns
    by = "superpopulation" if known else "sample_size"
    cohorts = populations.groupBy("population_code").agg(
        F.expr(f"CAST(min_by(sample_size, {by}) AS BIGINT)").alias("recorded_size"),
        F.expr("min(superpopulation)" if known else "CAST(NULL AS STRING)").alias(
            "superpopulation"
        ),
    )
    published = F.broadcast(literature_table(populations.sparkSession, study))
    categories = ", ".join(
        f"named_struct('phenotype_category', {literal(label)}, '_share', {share})"
        for label, share in zip(study.default_categories, equilibrium_shares("allele_frequency"))
    )
    return (
        cohorts.join(published, "population_code")
        .selectExpr("*", f"inline(array({categories}))")
        .selectExpr("*", "CAST(rint(_share * recorded_size) AS BIGINT) AS individual_count")
        .selectExpr(*CANDIDATE_KEYS, "_share", "data_source", "TRUE AS _published")
    )
