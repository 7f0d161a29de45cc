"""Projections of the result tables for the JSON artifacts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope import domain
from cohortscope.functions.numbers import rounded
from cohortscope.functions.text import filled
from cohortscope.schemas import FREQUENCIES, IMPACT, PHENOTYPES, POPULATIONS, RANKING, columns_of
from cohortscope.study import Study

ARTIFACT_COLUMNS = {
    "allele_frequencies": columns_of(FREQUENCIES),
    "phenotype_distribution": columns_of(PHENOTYPES),
    "drug_impact_summary": columns_of(IMPACT),
    "actionability_ranking": columns_of(RANKING),
}


def artifact(df: DataFrame, name: str) -> DataFrame:
    """The artifact's columns that the table has, in the artifact's order."""
    return df.select([c for c in ARTIFACT_COLUMNS[name] if c in df.columns])


def frequency_export(
    frequencies: DataFrame, variant_ids: Sequence[str] = domain.EXPORT_VARIANT_IDS
) -> DataFrame:
    columns = [
        c for c in columns_of(FREQUENCIES) if c not in ("reference_allele", "alternate_allele")
    ]
    return (
        frequencies.where(F.col("variant_id").isin(list(variant_ids)))
        .select(columns)
        .orderBy("gene_symbol", "population_code", "variant_id")
    )


def phenotype_export(phenotypes: DataFrame) -> DataFrame:
    columns = [c for c in columns_of(PHENOTYPES) if c != "data_source"]
    return phenotypes.select(columns).orderBy(
        "gene_symbol", "population_code", "phenotype_category"
    )


def impact_export(impact: DataFrame) -> DataFrame:
    return impact.select(columns_of(IMPACT)).orderBy(
        "drug_name", "gene_symbol", "population_code"
    )


def ranking_export(ranking: DataFrame) -> DataFrame:
    return ranking.select(columns_of(RANKING)).orderBy("rank_position")


def population_export(populations: DataFrame) -> DataFrame:
    columns = ["population_code", "population_name", "superpopulation", "region", "sample_size"]
    assert set(columns) == set(columns_of(POPULATIONS))
    return populations.select(columns).orderBy("population_code")


def document_frequencies(frequencies: DataFrame) -> DataFrame:
    return frequencies.select(
        "gene_symbol", "population_code", "variant_id", "allele_frequency", "snapshot_date"
    ).orderBy("gene_symbol", "population_code", "variant_id")


def document_phenotypes(phenotypes: DataFrame) -> DataFrame:
    return phenotypes.select(
        "gene_symbol",
        "population_code",
        "phenotype_category",
        "phenotype_percentage",
        "snapshot_date",
    ).orderBy("gene_symbol", "population_code", "phenotype_category")


def typed_rows(
    rows: DataFrame,
    integers: Sequence[str] = (),
    decimals: Sequence[str] = (),
    booleans: Sequence[str] = (),
) -> DataFrame:
    """All-text result rows with their types back; blanks are null, blank flags false."""

    def typed(name: str) -> str:
        value = filled(name)
        if name in integers:
            return f"CAST({value} AS BIGINT)"
        if name in decimals:
            return rounded(f"CAST({value} AS DOUBLE)", 6)
        if name in booleans:
            return f"coalesce(lower({value}) = 'true', FALSE)"
        return value

    return rows.selectExpr([f"{typed(c)} AS {c}" for c in rows.columns])


def run_metadata(
    populations: DataFrame, frequencies: DataFrame, study: Study, run_id: str, generated_at: str
) -> DataFrame:
    """One row describing a run; ``frequencies`` may be any table with its row count.

    The cohort map holds one entry per cohort and is the document's content, so it is
    the one place where a whole (small) table ends up in a single value.
    """
    entry = F.struct(
        F.col("population_code"),
        F.struct(
            F.col("population_name").alias("name"), "region", "superpopulation", "sample_size"
        ),
    )
    # A cohort listed under several superpopulations keeps the last one, as a map would.
    last = populations.groupBy("population_code").agg(
        F.max_by(entry, "superpopulation").alias("entry")
    )
    cohorts = last.agg(
        F.map_from_entries(F.sort_array(F.collect_list("entry"))).alias("populations")
    )
    total = frequencies.agg(F.count(F.lit(1)).alias("n")).scalar()
    sources = [
        F.lit(v).alias(k) for k, v in domain.ARTIFACT_SOURCE_VERSIONS.items()
    ]
    return cohorts.select(
        F.lit(domain.ARTIFACT_SCHEMA_VERSION).alias("schema_version"),
        F.lit(study.snapshot_date).alias("snapshot_date"),
        F.lit(run_id).alias("pipeline_run_id"),
        F.struct(*sources).alias("source_versions"),
        "populations",
        total.alias("total_variants_analyzed"),
        F.lit(generated_at).alias("generated_at"),
    )
