"""Allele frequencies per variant and cohort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.functions import literal
from cohortscope.functions.numbers import rounded, wilson
from cohortscope.schemas import FREQUENCIES, conform_present
from cohortscope.study import Study

GROUP_KEYS = (
    "variant_id",
    "gene_symbol",
    "chromosome",
    "position",
    "reference_allele",
    "alternate_allele",
    "population_code",
    "superpopulation",
)


def flagged_variants(clinical_variants: DataFrame) -> DataFrame:
    return (
        clinical_variants.where("is_actionable")
        .selectExpr("variant_rsid AS variant_id")
        .distinct()
        .selectExpr("variant_id", "TRUE AS _flagged")
    )


def build_allele_frequencies(
    variants: DataFrame,
    clinical_variants: DataFrame,
    study: Study,
    single_calls: bool = False,
    hemizygous: bool = False,
    min_maf: float | None = None,
) -> DataFrame:
    """Frequency, Wilson bounds and distance from the baseline cohort.

    ``single_calls`` promises one row per (sample, variant), which the variants table
    has; counting samples then needs no second shuffle. Options that are off by default:
    ``hemizygous`` totals by genotype length, ``min_maf`` keeps commoner variants.
    """
    present = set(variants.columns)
    keys = [k for k in GROUP_KEYS if k in present]
    people = "count(sample_id)" if single_calls else "count(DISTINCT sample_id)"
    total = f"2 * {people}"
    if hemizygous:
        total = "sum(size(split(genotype, '[|/]')))"
    counted = (
        variants.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
        .groupBy(*keys)
        .agg(
            F.expr("coalesce(sum(allele_dosage), 0L)").alias("allele_count"),
            F.expr(f"CAST({total} AS BIGINT)").alias("total_alleles"),
        )
    )
    return rate_frequencies(counted, keys, clinical_variants, study, min_maf)


def rate_frequencies(
    counted: DataFrame,
    keys: Sequence[str],
    clinical_variants: DataFrame,
    study: Study,
    min_maf: float | None = None,
) -> DataFrame:
    """Frequencies, bounds and distances from allele_count and total_alleles per key."""
    rated = counted.selectExpr(
        "*",
        f"{rounded('allele_count / total_alleles', 6)} AS allele_frequency",
        f"{wilson('allele_count', 'total_alleles')} AS _ci",
    ).selectExpr(
        *keys,
        "allele_count",
        "total_alleles",
        "allele_frequency",
        f"{rounded('_ci.lower', 6)} AS ci_lower_wilson",
        f"{rounded('_ci.upper', 6)} AS ci_upper_wilson",
    )
    compared = with_baseline_frequency(rated, study.baseline)
    if min_maf is not None:  # after the comparison: a rare baseline still is the baseline
        compared = compared.where(f"least(allele_frequency, 1 - allele_frequency) > {min_maf!r}D")
    flagged = compared.join(flagged_variants(clinical_variants), "variant_id", "left")
    return conform_present(
        flagged.selectExpr(
            "*",
            "coalesce(_flagged, FALSE) AS is_actionable",
            f"DATE'{study.snapshot_date}' AS snapshot_date",
        ),
        FREQUENCIES,
    )


def with_baseline_frequency(rated: DataFrame, baseline: str) -> DataFrame:
    """Adds ``delta_vs_ceu``; null where the baseline cohort lacks the variant.

    A window over the aggregated rows replaces the self-join, which would compute the
    facts twice. One row comes out per baseline row of the variant id, as from the join:
    two alleles that share a positional id fan out.
    """
    reference = f"CASE WHEN population_code = {literal(baseline)} THEN allele_frequency END"
    return (
        rated.selectExpr(
            "*", f"collect_list({reference}) OVER (PARTITION BY variant_id) AS _references"
        )
        .selectExpr("*", "explode_outer(_references) AS _reference")
        .selectExpr("*", f"{rounded('allele_frequency - _reference', 6)} AS delta_vs_ceu")
        .drop("_references", "_reference")
    )


def top_variants_per_gene(frequencies: DataFrame, size: int = 40) -> DataFrame:
    """All rows of the ``size`` variants per gene farthest from the baseline."""
    chosen = (
        frequencies.groupBy("gene_symbol", "variant_id")
        .agg(F.expr("max(abs(delta_vs_ceu))").alias("_spread"))
        .selectExpr(
            "gene_symbol",
            "variant_id",
            "row_number() OVER (PARTITION BY gene_symbol "
            "ORDER BY _spread DESC NULLS LAST, variant_id) AS _place",
        )
        .where(f"_place <= {int(size)}")
    )
    return frequencies.join(chosen, ["gene_symbol", "variant_id"], "left_semi")
