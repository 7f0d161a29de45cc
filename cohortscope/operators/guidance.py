"""Prescribing guidance: flattening, classification, curated overrides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.functions import literals
from cohortscope.functions.text import blank_if_null, filled, name_key, recommendation_flags
from cohortscope.operators.dedup import keep_first, lookup_side
from cohortscope.operators.dimensions import curated_table
from cohortscope.schemas import GUIDANCE, RECOMMENDATIONS, columns_of, conform, conform_present
from cohortscope.study import Study

KEYS = ("gene_symbol", "drug_name", "phenotype")


def by_gene(values: str, gene: str) -> str:
    """Entry for a gene, then for its upper-cased symbol, else an empty string."""
    return f"coalesce({filled(f'{values}[{gene}]')}, {values}[upper({gene})], '')"


def flatten_recommendations(
    recommendations: DataFrame, guidelines: DataFrame, drugs: DataFrame
) -> DataFrame:
    """One row per recommendation and gene of its guideline.

    Recommendations of unknown guidelines are dropped; an unknown drug keeps its id.
    """
    known = lookup_side(
        guidelines.selectExpr(
            f"{blank_if_null('id')} AS guidelineid", "genes AS _genes", "version AS _version"
        ),
        "guidelineid",
    )
    named = lookup_side(
        drugs.where("drugid <> '' AND name <> ''").selectExpr("drugid", "name AS _drug"),
        "drugid",
    )
    rows = (
        recommendations.selectExpr(
            "id",
            f"{blank_if_null('guidelineid')} AS guidelineid",
            f"{blank_if_null('drugid')} AS drugid",
            "drugrecommendation",
            "classification",
            "phenotypes",
            "activityscore",
        )
        .join(known, "guidelineid")
        .join(named, "drugid", "left")
        .selectExpr(
            "*",
            "explode(CASE WHEN size(_genes) > 0 THEN _genes ELSE map_keys(phenotypes) END) "
            "AS gene_symbol",
        )
        .selectExpr(
            f"concat(guidelineid, ':', {blank_if_null('CAST(id AS STRING)')}) AS guideline_id",
            "gene_symbol",
            "coalesce(_drug, drugid) AS drug_name",
            f"{by_gene('phenotypes', 'gene_symbol')} AS phenotype",
            f"{by_gene('activityscore', 'gene_symbol')} AS activity_score",
            f"{blank_if_null('drugrecommendation')} AS recommendation_text",
            f"{blank_if_null('classification')} AS classification_strength",
            f"{blank_if_null('CAST(_version AS STRING)')} AS cpic_release_version",
        )
    )
    return conform(rows, GUIDANCE)


def classify(guidance: DataFrame) -> DataFrame:
    """Adds the two action flags."""
    change, alternative = recommendation_flags("recommendation_text", "classification_strength")
    return guidance.selectExpr(
        "*", f"{change} AS requires_dose_change", f"{alternative} AS requires_alternative"
    )


def override(rows: DataFrame, curated: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All curated rows, and the other rows whose key is not curated (nulls match).

    The curated rows are a local table of checked length, hence the broadcast.
    """
    same = F.expr(" AND ".join(f"r.{k} <=> c.{k}" for k in keys))
    kept = rows.alias("r").join(F.broadcast(curated).alias("c"), same, "left_anti")
    return kept.unionByName(curated)


def build_recommendations(
    guidance: DataFrame,
    study: Study,
    order_by: Sequence[str] = ("guideline_id", "recommendation_text"),
) -> DataFrame:
    """Classified in-scope guidance, one row per gene, drug and phenotype.

    Curated rows replace source rows of the same key. They are added only when the source
    has in-scope rows at all.
    """
    scoped = guidance.where(f"gene_symbol IN ({literals(study.scope_genes)})")
    columns = [c for c in columns_of(RECOMMENDATIONS) if c != "drug_name"]
    flagged = classify(scoped)
    present = set(flagged.columns)
    order = [c for c in order_by if c in present]
    kept = [c for c in columns if c in present]
    named = flagged.selectExpr(
        f"{name_key('drug_name')} AS drug_name", *kept, *[c for c in order if c not in kept]
    )
    single = keep_first(named, KEYS, order).select("drug_name", *kept)
    # The existence test is a scalar subquery that stops at the first row.
    curated = curated_table(guidance.sparkSession, study).where(
        scoped.select(F.lit(1)).exists()
    )
    return conform_present(override(single, curated), RECOMMENDATIONS)
