"""Text documents about ranked drug, gene and cohort combinations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope import domain
from cohortscope.functions import literal, lookup
from cohortscope.functions.numbers import decimal_units, tenths
from cohortscope.functions.text import blank_if_null

KEYS = ("gene_symbol", "population_code")


def dominant_categories(phenotypes: DataFrame) -> DataFrame:
    """The commonest category per gene and cohort, the first by name on a tie."""
    return phenotypes.groupBy(*KEYS).agg(
        F.expr(
            "min(struct(-coalesce(phenotype_percentage, 0D) AS rank, phenotype_category AS name))"
        )["name"].alias("dominant_category")
    )


def mean_frequencies(frequencies: DataFrame) -> DataFrame:
    """Unweighted mean frequency over the variants of a gene, per cohort.

    Frequencies have six decimals, so a decimal sum is exact whatever the order.
    """
    exact = "CAST(coalesce(allele_frequency, 0D) AS DECIMAL(20, 6))"
    return frequencies.groupBy(*KEYS).agg(
        F.expr(f"CAST(sum({exact}) AS DOUBLE) / count(*)").alias("mean_frequency")
    )


def build_documents(
    ranking: DataFrame,
    phenotypes: DataFrame,
    frequencies: DataFrame,
    prefix: str = domain.DOCUMENT_PREFIX,
) -> DataFrame:
    """(path, document) per gene, cohort and drug; the last rank wins a shared path."""
    known = ranking.where("gene_symbol <> '' AND population_code <> '' AND drug_name <> ''")
    described = known.join(dominant_categories(phenotypes), list(KEYS), "left").join(
        mean_frequencies(frequencies), list(KEYS), "left"
    )
    country = lookup("population_code", domain.COHORT_COUNTRIES, "population_code")
    document = (
        "concat('Gene: ', gene_symbol, '\\n', "
        f"'Population: ', population_code, ' (', {country}, ')\\n', "
        "'Drug: ', drug_name, '\\n', "
        "'Phenotype: ', coalesce(dominant_category, 'Unknown'), '\\n', "
        f"'Allele frequency: ', {tenths('_tenths')}, '%\\n', "
        f"'Actionability: CPIC ', {blank_if_null('classification_strength')}, '\\n', "
        f"'Clinical implication: ', {blank_if_null('clinical_implication')}, '\\n')"
    )
    path = (
        f"concat({literal(prefix)}, '/', gene_symbol, '/', population_code, '/', "
        "translate(drug_name, ' /', '_-'), '.txt')"
    )
    return (
        described.selectExpr("*", "coalesce(mean_frequency, 0D) * 100D AS _percent")
        .selectExpr("*", f"CAST({decimal_units('_percent', 1)} AS BIGINT) AS _tenths")
        .selectExpr(f"{path} AS path", f"{document} AS document", "rank_position")
        .groupBy("path")
        .agg(F.max_by("document", "rank_position").alias("document"))
    )
