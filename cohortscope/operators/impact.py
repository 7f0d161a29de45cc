"""People whose inferred category calls for a change of therapy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.functions import literal
from cohortscope.functions.genome import any_of
from cohortscope.functions.numbers import rounded, rounded_exactly
from cohortscope.functions.text import name_key
from cohortscope.operators.phenotypes import category, cohort_sizes
from cohortscope.schemas import IMPACT, conform
from cohortscope.study import Study

BASELINE_KEYS = ("drug_name", "gene_symbol")
STRICT_BASELINE_KEYS = (*BASELINE_KEYS, "classification_strength")

GROUP_KEYS = (
    "drug_name",
    "gene_symbol",
    "population_code",
    "population_total",
    "classification_strength",
)


def build_drug_impact(
    phenotypes: DataFrame,
    recommendations: DataFrame,
    study: Study,
    baseline_keys: Sequence[str] = BASELINE_KEYS,
) -> DataFrame:
    """Affected share per drug, gene, cohort and strength, against the baseline cohort."""
    actionable = recommendations.where(
        "requires_dose_change OR requires_alternative"
    ).selectExpr(
        "gene_symbol",
        f"{name_key('drug_name')} AS drug_name",
        "phenotype AS phenotype_category",
        "classification_strength",
    )
    summed = (
        phenotypes.select(
            "gene_symbol",
            "phenotype_category",
            "population_code",
            "population_total",
            "individual_count",
        )
        .join(actionable, ["gene_symbol", "phenotype_category"])
        .where(" AND ".join(f"{k} IS NOT NULL" for k in GROUP_KEYS))
        .groupBy(*GROUP_KEYS)
        .agg(F.sum("individual_count").alias("individuals_requiring_change"))
    )
    share = "individuals_requiring_change / population_total * 100D"
    rated = summed.selectExpr("*", f"{rounded(share, 2)} AS percentage_requiring_change")
    return with_baseline_percentage(rated, study, baseline_keys)


def with_baseline_percentage(
    impact: DataFrame, study: Study, keys: Sequence[str] = BASELINE_KEYS
) -> DataFrame:
    """Adds the baseline cohort's percentage (0 if it has none) and the distance from it.

    Without the strength in ``keys`` a drug and gene with several strengths in the
    baseline yields one row per baseline row; the window lists them without computing
    the input twice.
    """
    reference = (
        f"CASE WHEN population_code = {literal(study.baseline)} "
        "THEN percentage_requiring_change END"
    )
    difference = "percentage_requiring_change - baseline_ceu_percentage"
    compared = (
        impact.selectExpr(
            "*", f"collect_list({reference}) OVER (PARTITION BY {', '.join(keys)}) AS _references"
        )
        .selectExpr("*", "explode_outer(_references) AS _reference")
        .selectExpr("*", "coalesce(_reference, 0D) AS baseline_ceu_percentage")
        .selectExpr(
            "*",
            f"{rounded(difference, 2)} AS delta_vs_baseline",
            f"DATE'{study.snapshot_date}' AS snapshot_date",
        )
    )
    return conform(compared, IMPACT)


def build_joint_impact(dosages: DataFrame, populations: DataFrame, study: Study) -> DataFrame:
    """Share of each cohort whose two-gene category pair needs another than standard dose.

    Both genes come out of one conditional aggregate over ``individual_dosage`` rows
    instead of a join of two of them.
    """
    joint = study.joint
    first, second = joint.genes
    people = dosages.groupBy("sample_id", "population_code").agg(
        *[
            F.expr(f"sum(CASE WHEN gene_symbol = {literal(gene)} THEN total_dosage END)").alias(name)
            for gene, name in ((first, "_first"), (second, "_second"))
        ]
    )
    changed = any_of(
        f"_category1 = {literal(a)} AND _category2 = {literal(b)}"
        for (a, b), dose in joint.doses.items()
        if dose != joint.standard
    )
    summed = (
        people.where("_first IS NOT NULL AND _second IS NOT NULL")
        .selectExpr(
            "population_code",
            f"{category('_first', literal(first), study)} AS _category1",
            f"{category('_second', literal(second), study)} AS _category2",
        )
        .groupBy("population_code")
        .agg(
            F.expr(f"count_if({changed})").alias("individuals_requiring_change"),
            F.count(F.lit(1)).alias("_observed"),
        )
        .join(cohort_sizes(populations), "population_code", "left")
        .selectExpr(
            f"{literal(joint.drug)} AS drug_name",
            f"{literal(joint.label)} AS gene_symbol",
            "population_code",
            "coalesce(recorded_size, _observed) AS population_total",
            "individuals_requiring_change",
            f"{literal(joint.strength)} AS classification_strength",
            "individuals_requiring_change / population_total * 100D AS _percent",
        )
        .where("population_total <> 0")
        .selectExpr("*", f"{rounded_exactly('_percent', 2)} AS percentage_requiring_change")
    )
    return with_baseline_percentage(summed, study)
