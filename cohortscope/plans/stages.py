"""Batch stages: bronze, silver, gold, artifacts.

Each stage reads stored tables and stores its own, so a lost executor costs tasks of one
stage only and no result is computed twice.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscope.operators import exports
from cohortscope.operators.clinical import build_clinical_variants
from cohortscope.operators.cohorts import build_pharmacogenes, build_populations
from cohortscope.operators.documents import build_documents
from cohortscope.operators.frequencies import build_allele_frequencies
from cohortscope.operators.guidance import build_recommendations, flatten_recommendations
from cohortscope.operators.impact import build_drug_impact, build_joint_impact
from cohortscope.operators.phenotypes import build_phenotypes, individual_dosage
from cohortscope.operators.quality import MINIMUM_ROWS, require_rows
from cohortscope.operators.ranking import build_ranking
from cohortscope.operators.variants import build_variants, require_calls
from cohortscope.sinks.artifacts import export_artifact, write_documents, write_json
from cohortscope.sinks.tables import upsert_table, write_bronze, write_table, write_variants
from cohortscope.sources import annotation_files as files
from cohortscope.sources.registered import Registered
from cohortscope.sources.tables import read_date, read_latest, read_table
from cohortscope.sources.variant_files import read_genotypes
from cohortscope.study import Study


@dataclass(frozen=True)
class Layout:
    """Where the tables of a run live: folders, or tables of a database of the catalog.

    With ``sample_buckets`` the genotype facts of silver are bucketed by sample as well, and with
    ``calls_per_file`` the files of the genotype calls in bronze cover narrow ranges of positions.
    """

    root: str
    database: str | None = None
    sample_buckets: int | None = None
    calls_per_file: int | None = None

    def _table(self, tier: str, table: str) -> str | Registered:
        path = f"{self.root}/{tier}/{table}"
        return Registered(f"{self.database}.{tier}_{table}", path) if self.database else path

    def bronze(self, table: str) -> str | Registered:
        return self._table("bronze", table)

    def silver(self, table: str) -> str | Registered:
        return self._table("silver", table)

    def gold(self, table: str) -> str | Registered:
        return self._table("gold", table)

    def artifacts(self) -> str:
        return f"{self.root}/artifacts"


def ingest_genotypes(
    spark: SparkSession, calls: str, panel: str, layout: Layout, day: date, study: Study
) -> None:
    write_bronze(files.read_panel(spark, panel), layout.bronze("samples_metadata_raw"), day)
    samples = read_latest(spark, layout.bronze("samples_metadata_raw")).where(
        F.col("population_code").isin(list(study.target_cohorts))
    )
    write_bronze(
        read_genotypes(spark, calls, samples, study),
        layout.bronze("genomes_variants_raw"),
        day,
        extra_partition={"chromosome_part": F.col("chromosome")},
        order_by=("position", "variant_id"),
        rows_per_file=layout.calls_per_file,
    )


def ingest_annotations(
    spark: SparkSession, paths: dict[str, str], layout: Layout, day: date
) -> None:
    """``paths`` maps bronze table names to unpacked TSV files."""
    for mapping in (
        files.CLINICAL_ANNOTATIONS, files.DRUG_ANNOTATIONS, files.DRUGS, files.GENES,
    ):
        if mapping.table in paths:
            table = files.read_annotations(spark, paths[mapping.table], mapping)
            write_bronze(table, layout.bronze(mapping.table), day)


def ingest_guidance(
    spark: SparkSession,
    recommendations: str,
    guidelines: str,
    drugs: str,
    layout: Layout,
    day: date,
) -> None:
    rows = flatten_recommendations(
        files.read_recommendations(spark, recommendations),
        files.read_guidelines(spark, guidelines),
        files.read_drug_names(spark, drugs),
    )
    if rows.isEmpty():
        raise RuntimeError("guidance is empty after joining recommendations with guidelines")
    write_bronze(rows, layout.bronze("cpic_guidelines_raw"), day)


def check_bronze(
    spark: SparkSession, layout: Layout, minimum: dict[str, int] = MINIMUM_ROWS
) -> None:
    require_rows({name: read_latest(spark, layout.bronze(name)) for name in minimum}, minimum)


def build_silver(
    spark: SparkSession, layout: Layout, study: Study, day: date | None = None
) -> None:
    """Silver tables from the latest bronze date, or from a given one."""

    def bronze(table: str) -> DataFrame:
        root = layout.bronze(table)
        return read_latest(spark, root) if day is None else read_date(spark, root, day)

    samples = bronze("samples_metadata_raw")
    write_table(build_populations(samples, study), layout.silver("populations"))
    write_table(
        build_pharmacogenes(bronze("pharmgkb_genes_raw"), study), layout.silver("pharmacogenes")
    )
    calls = bronze("genomes_variants_raw")
    require_calls(calls, samples, study)
    write_variants(
        build_variants(calls, samples, study, single_calls=True),
        layout.silver("variants"),
        layout.sample_buckets,
    )
    write_table(
        build_clinical_variants(bronze("pharmgkb_clinical_annotations_raw"), study),
        layout.silver("clinical_variants"),
    )
    write_table(
        build_recommendations(bronze("cpic_guidelines_raw"), study),
        layout.silver("drug_recommendations"),
    )


#: Business keys of the gold tables; the first column is their partition.
GOLD_KEYS = {
    "allele_frequencies_by_population": [
        "gene_symbol", "variant_id", "chromosome", "position", "reference_allele",
        "alternate_allele", "population_code", "superpopulation",
    ],
    "phenotype_distribution_by_population": [
        "gene_symbol", "population_code", "superpopulation", "phenotype_category",
    ],
    "drug_impact_summary": [
        "drug_name", "gene_symbol", "population_code", "classification_strength",
    ],
}


def build_gold(spark: SparkSession, layout: Layout, study: Study) -> None:
    """Rows of this run replace stored rows of the same business key; other rows stay."""
    def silver(table: str) -> DataFrame:
        return read_table(spark, layout.silver(table))

    def store(df: DataFrame, table: str) -> DataFrame:
        upsert_table(df, layout.gold(table), GOLD_KEYS[table], GOLD_KEYS[table][:1])
        return read_table(spark, layout.gold(table))

    variants, populations = silver("variants"), silver("populations")
    store(
        build_allele_frequencies(
            variants, silver("clinical_variants"), study, single_calls=True
        ),
        "allele_frequencies_by_population",
    )
    phenotypes = store(
        build_phenotypes(individual_dosage(variants, study), populations, study),
        "phenotype_distribution_by_population",
    )
    joint = build_joint_impact(
        individual_dosage(variants, study, study.joint.genes), populations, study
    )
    impact = store(
        build_drug_impact(phenotypes, silver("drug_recommendations"), study).unionByName(joint),
        "drug_impact_summary",
    )
    # The ranking is one order over all stored impact rows, so it is replaced as a whole.
    write_table(build_ranking(impact, study), layout.gold("actionability_ranking"))


def export_artifacts(spark: SparkSession, layout: Layout, study: Study) -> dict[str, int]:
    """Row count per exported artifact."""
    tables = {
        "allele_frequencies": "allele_frequencies_by_population",
        "phenotype_distribution": "phenotype_distribution_by_population",
        "drug_impact_summary": "drug_impact_summary",
        "actionability_ranking": "actionability_ranking",
    }
    counts = {
        name: export_artifact(read_table(spark, layout.gold(table)), name, layout.artifacts())
        for name, table in tables.items()
    }
    metadata = exports.run_metadata(
        read_table(spark, layout.silver("populations")),
        read_table(spark, layout.gold("allele_frequencies_by_population")),
        study,
        run_id=str(uuid.uuid4()),
        generated_at=datetime.now(timezone.utc).replace(tzinfo=None).isoformat() + "Z",
    )
    write_json(metadata, f"{layout.artifacts()}/metadata")
    return counts


def publish_documents(spark: SparkSession, layout: Layout) -> None:
    documents = build_documents(
        read_table(spark, layout.gold("actionability_ranking")),
        read_table(spark, layout.gold("phenotype_distribution_by_population")),
        read_table(spark, layout.gold("allele_frequencies_by_population")),
    )
    write_documents(documents, f"{layout.artifacts()}/documents")
