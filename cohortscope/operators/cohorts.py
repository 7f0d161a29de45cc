"""Cohort and gene dimensions built from source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.functions import literals
from cohortscope.functions.text import whole_number
from cohortscope.operators.dimensions import cohort_table, region_table, scope_table
from cohortscope.schemas import PHARMACOGENES, POPULATIONS, conform
from cohortscope.study import Study


def build_populations(samples: DataFrame, study: Study) -> DataFrame:
    """Size, name and region of each cohort."""
    sizes = (
        samples.where(f"population_code IN ({literals(study.target_cohorts)})")
        .where("superpopulation IS NOT NULL")
        .groupBy("population_code", "superpopulation")
        .agg(F.count(F.lit(1)).alias("sample_size"))
    )
    names = F.broadcast(cohort_table(samples.sparkSession, study))
    named = sizes.join(names, "population_code", "left").selectExpr(
        "population_code",
        "coalesce(population_name, population_code) AS population_name",
        "superpopulation",
        "coalesce(region, 'Unknown') AS region",
        "sample_size",
    )
    return conform(named, POPULATIONS)


def build_pharmacogenes(genes: DataFrame, study: Study) -> DataFrame:
    """Scope genes with the source's coordinates, or the study's where it has no row.

    Both joins put the small scope table on the broadcast side, and the list of genes
    present is pre-aggregated, so repeated source rows of one gene never meet in a task.
    """
    scope = scope_table(genes.sparkSession, study)
    present = set(genes.columns)

    def source(column: str) -> str:
        return column if column in present else "CAST(NULL AS STRING)"

    listed_source = genes.where(
        f"gene_symbol IN ({literals(symbol for symbol, _, _ in study.scope)})"
    ).selectExpr(
        "gene_symbol",
        *[f"{source(c)} AS {c}" for c in ("ensembl_id", "ncbi_gene_id", "chromosome")],
        *[
            f"{whole_number(source(c))} AS {c}"
            for c in ("chromosomal_start", "chromosomal_end")
        ],
    )
    listed = listed_source.join(F.broadcast(scope), "gene_symbol")
    fallback = region_table(genes.sparkSession, study.regions).selectExpr(
        "gene_symbol",
        "chromosome",
        "region_start AS chromosomal_start",
        "region_end AS chromosomal_end",
    )
    unlisted = scope.join(
        listed_source.select("gene_symbol").distinct(), "gene_symbol", "left_anti"
    ).join(F.broadcast(fallback), "gene_symbol", "left")
    return conform(listed.unionByName(unlisted, allowMissingColumns=True), PHARMACOGENES)
