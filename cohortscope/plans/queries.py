"""Queries over the driver's tables, one per operator family."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscope.functions.text import name_key
from cohortscope.operators import exports
from cohortscope.operators.clinical import build_clinical_variants, with_cross_references
from cohortscope.operators.cohorts import build_pharmacogenes, build_populations
from cohortscope.operators.documents import (
    build_documents,
    dominant_categories,
    mean_frequencies,
)
from cohortscope.operators.frequencies import (
    build_allele_frequencies,
    top_variants_per_gene,
)
from cohortscope.operators.frequency_state import (
    frequencies_of_state,
    frequency_state,
    merge_states,
    number_samples,
)
from cohortscope.operators.guidance import (
    classify,
    flatten_recommendations,
    override,
)
from cohortscope.operators.dimensions import curated_table
from cohortscope.operators.impact import (
    STRICT_BASELINE_KEYS,
    build_drug_impact,
    build_joint_impact,
)
from cohortscope.operators.intervals import assign_genes_by_bins
from cohortscope.operators.melt import assemble_variants, parse_records
from cohortscope.operators.phenotypes import (
    build_phenotypes,
    individual_dosage,
    nonfunctional_copies,
)
from cohortscope.operators.quality import null_counts, row_gate, scope_status
from cohortscope.operators.ranking import build_ranking, rank_all
from cohortscope.operators.upsert import upsert
from cohortscope.operators.variants import assign_genes
from cohortscope.plans import driver_tables as dt
from cohortscope.schemas import RAW_RECOMMENDATIONS
from cohortscope.sinks.tables import upsert_table, write_bronze, write_table, write_variants
from cohortscope.sources.annotation_files import CLINICAL_ANNOTATIONS, build_panel, map_columns
from cohortscope.sources.record_files import split_records
from cohortscope.sources.registered import Registered
from cohortscope.sources.tables import read_latest, read_table

Query = Callable[[SparkSession, str], DataFrame]

STUDY = dt.STUDY
UNSIZED_COHORT = "NATION_5"
EXPORTED_VARIANTS = ("chr1:0", "chr1:125", "chr2:150", "chr3:300", "chr4:200")


def populations(spark: SparkSession, sf: str) -> DataFrame:
    return build_populations(dt.samples(spark, sf), STUDY)


def recorded_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Cohort sizes, of which one is missing: its people are counted instead."""
    return populations(spark, sf).where(f"population_code <> '{UNSIZED_COHORT}'")


def clinical_variants(spark: SparkSession, sf: str) -> DataFrame:
    return build_clinical_variants(dt.annotations(spark, sf), STUDY)


def allele_frequencies(spark: SparkSession, sf: str, **options) -> DataFrame:
    return build_allele_frequencies(
        dt.variants(spark, sf), clinical_variants(spark, sf), STUDY, single_calls=True, **options
    )


def gene_assignment(spark: SparkSession, sf: str) -> DataFrame:
    located = assign_genes(dt.sites(dt.table(spark, sf, "lineitem")), STUDY.regions)
    return located.groupBy("chromosome", "position", "gene_symbol").agg(
        F.count(F.lit(1)).alias("line_count")
    )


def dosages(spark: SparkSession, sf: str) -> DataFrame:
    return individual_dosage(dt.variants(spark, sf), STUDY)


def individual_dosages(spark: SparkSession, sf: str) -> DataFrame:
    return dosages(spark, sf).selectExpr(
        "*", f"{nonfunctional_copies(STUDY)} AS nonfunctional_copies"
    )


def phenotype_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return build_phenotypes(dosages(spark, sf), recorded_sizes(spark, sf), STUDY)


def literature_correction(spark: SparkSession, sf: str) -> DataFrame:
    return phenotype_distribution(spark, sf).where(F.col("data_source") == "literature")


def drug_impact(spark: SparkSession, sf: str) -> DataFrame:
    return build_drug_impact(
        phenotype_distribution(spark, sf), dt.recommendations(spark, sf), STUDY
    )


def drug_impact_strict(spark: SparkSession, sf: str) -> DataFrame:
    return build_drug_impact(
        phenotype_distribution(spark, sf),
        dt.recommendations(spark, sf),
        STUDY,
        STRICT_BASELINE_KEYS,
    )


def joint_impact(spark: SparkSession, sf: str) -> DataFrame:
    people = individual_dosage(dt.variants(spark, sf), STUDY, STUDY.joint.genes)
    return build_joint_impact(people, recorded_sizes(spark, sf), STUDY)


def all_impact(spark: SparkSession, sf: str) -> DataFrame:
    """Single-gene and joint impact from the same dosage rows (one shared exchange)."""
    people, cohorts = dosages(spark, sf), recorded_sizes(spark, sf)
    single = build_drug_impact(
        build_phenotypes(people, cohorts, STUDY), dt.recommendations(spark, sf), STUDY
    )
    return single.unionByName(build_joint_impact(people, cohorts, STUDY))


def actionability_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return build_ranking(all_impact(spark, sf), STUDY)


def recommendation_flags(spark: SparkSession, sf: str) -> DataFrame:
    return classify(dt.guidance(spark, sf)).select(
        "guideline_id", "requires_dose_change", "requires_alternative"
    )


def curated_override(spark: SparkSession, sf: str) -> DataFrame:
    rows = classify(dt.guidance(spark, sf)).drop("guideline_id", "activity_score")
    rows = rows.withColumn("drug_name", F.expr(name_key("drug_name")))
    return override(rows, curated_table(spark, STUDY))


def guideline_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_recommendations(
        dt.raw_recommendations(spark, sf), dt.raw_guidelines(spark, sf), dt.raw_drugs(spark, sf)
    )


def genotype_melt(spark: SparkSession, sf: str) -> DataFrame:
    records = parse_records(dt.variant_lines(spark, sf), STUDY)
    return assemble_variants(records, dt.line_columns(spark, sf))


def cross_reference_ids(spark: SparkSession, sf: str) -> DataFrame:
    return with_cross_references(dt.drug_references(spark, sf))


def gene_scope_table(spark: SparkSession, sf: str) -> DataFrame:
    return build_pharmacogenes(dt.gene_rows(spark, sf), STUDY)


def gene_scope_check(spark: SparkSession, sf: str) -> DataFrame:
    genes = dt.gene_rows(spark, sf).groupBy("gene_symbol").agg(F.count(F.lit(1)).alias("rows"))
    return scope_status(genes, STUDY)


def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return (
        null_counts(dt.guidance(spark, sf), "cpic_guidelines_raw")
        .unionByName(null_counts(dt.samples(spark, sf), "samples_metadata_raw"))
        .unionByName(
            null_counts(dt.annotations(spark, sf), "pharmgkb_clinical_annotations_raw")
        )
    )


def row_counts_gate(spark: SparkSession, sf: str) -> DataFrame:
    tables = {name: dt.table(spark, sf, name) for name in ("lineitem", "part", "nation")}
    return row_gate(tables, {"lineitem": 1000, "part": 100, "nation": 1000})


def dominant_and_mean(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["gene_symbol", "population_code"]
    means = mean_frequencies(allele_frequencies(spark, sf))
    return dominant_categories(phenotype_distribution(spark, sf)).join(means, keys, "full")


def knowledge_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The phenotype table feeds both the ranking and the documents."""
    people, cohorts = dosages(spark, sf), recorded_sizes(spark, sf)
    phenotypes = build_phenotypes(people, cohorts, STUDY)
    impact = build_drug_impact(phenotypes, dt.recommendations(spark, sf), STUDY).unionByName(
        build_joint_impact(people, cohorts, STUDY)
    )
    return build_documents(
        build_ranking(impact, STUDY), phenotypes, allele_frequencies(spark, sf)
    )


def export_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return exports.frequency_export(allele_frequencies(spark, sf), EXPORTED_VARIANTS)


def export_phenotypes(spark: SparkSession, sf: str) -> DataFrame:
    return exports.phenotype_export(phenotype_distribution(spark, sf))


def export_impact(spark: SparkSession, sf: str) -> DataFrame:
    return exports.impact_export(drug_impact(spark, sf))


def export_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return exports.ranking_export(actionability_ranking(spark, sf))


def document_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return exports.document_frequencies(allele_frequencies(spark, sf))


def document_phenotypes(spark: SparkSession, sf: str) -> DataFrame:
    return exports.document_phenotypes(phenotype_distribution(spark, sf))


def artifact_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return exports.artifact(allele_frequencies(spark, sf), "allele_frequencies")


def artifact_phenotypes(spark: SparkSession, sf: str) -> DataFrame:
    return exports.artifact(phenotype_distribution(spark, sf), "phenotype_distribution")


def artifact_impact(spark: SparkSession, sf: str) -> DataFrame:
    return exports.artifact(all_impact(spark, sf), "drug_impact_summary")


def artifact_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return exports.artifact(actionability_ranking(spark, sf), "actionability_ranking")


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Raw panel headers, the newer one for sex and none for the family."""
    return build_panel(
        dt.samples(spark, sf).selectExpr(
            "sample_id AS sample", "population_code AS pop", "superpopulation AS super_pop",
            "CASE WHEN superpopulation < 'M' THEN 'male' ELSE 'female' END AS gender",
        )
    )


def header_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """Source headers, old and new, to columns; an old header fills the gaps of the new one."""
    raw = dt.annotations(spark, sf).selectExpr(
        "clinical_annotation_id AS `Clinical Annotation ID`",
        "gene_symbol AS `Gene`",
        "drug_names AS `Drug(s)`",
        "CASE WHEN gene_symbol <> 'G1' THEN evidence_level END AS `Level of Evidence`",
        "concat('old ', evidence_level) AS `Evidence Level`",
        "1 AS `Not wanted`",
    )
    return map_columns(raw, CLINICAL_ANNOTATIONS)


def guidance_records(spark: SparkSession, sf: str) -> DataFrame:
    """Nested guidance records, read from JSON with the declared schema."""
    written = dt.raw_recommendations(spark, sf).selectExpr(
        "to_json(struct(CAST(id AS BIGINT) AS id, guidelineid, drugid, classification, phenotypes, "
        "activityscore, 'more' AS unknown)) AS record"
    )
    read = written.selectExpr(f"from_json(record, '{RAW_RECOMMENDATIONS}') AS r")
    return read.selectExpr(
        "r.id", "r.guidelineid", "r.drugid", "r.drugrecommendation", "r.classification",
        "r.phenotypes['G1'] AS first_phenotype", "size(r.phenotypes) AS phenotype_count",
        "r.activityscore['G1'] AS first_score",
    )


def guidance_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Guidance records by the reader's rules: values of any type as text, other shapes named."""
    found = split_records(dt.record_lines(spark, sf), RAW_RECOMMENDATIONS)
    return found.selectExpr(
        "file", "id", "guidelineid", "phenotypes['G1'] AS first_phenotype",
        "phenotypes['G2'] AS second_phenotype", "activityscore['G1'] AS first_score", "problem",
    )


def frequencies_from_repeated_calls(spark: SparkSession, sf: str) -> DataFrame:
    """Calls without alternate alleles come twice; samples count once."""
    found = dt.variants(spark, sf)
    twice = found.unionByName(found.where("allele_dosage = 0"))
    return build_allele_frequencies(twice, clinical_variants(spark, sf), STUDY)


def frequencies_from_dates(spark: SparkSession, sf: str) -> DataFrame:
    """The repeated calls come on other ingest dates; each date is counted by itself."""
    found = dt.variants(spark, sf).withColumn("day", F.expr("position div 25 % 3"))
    calls = found.unionByName(found.where("allele_dosage = 0").withColumn("day", F.expr("(day + 1) % 3")))
    numbers = number_samples(dt.samples(spark, sf))
    states = [frequency_state(calls.where(F.col("day") == day), numbers) for day in range(3)]
    merged = merge_states(states[0].unionByName(states[1]).unionByName(states[2]))
    return frequencies_of_state(merged, clinical_variants(spark, sf), STUDY)


def gene_assignment_by_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Positions of order lines against one region for each part, many of which overlap."""
    sites = dt.spread_sites(spark, sf).groupBy("chromosome", "position").agg(
        F.count(F.lit(1)).alias("line_count")
    )
    located = assign_genes_by_bins(sites, dt.part_regions(spark, sf))
    return located.select("chromosome", "position", "gene_symbol", "line_count")


def impact_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """A place for every impact row, by ranges of the order."""

    def store(df: DataFrame) -> DataFrame:
        table = _new_table(spark, "ranges")
        write_table(df, table)
        return read_table(spark, table)

    return rank_all(all_impact(spark, sf), STUDY, store).select(
        "rank_position", "drug_name", "gene_symbol", "population_code", "classification_strength",
        "delta_vs_baseline",
    )


def _new_table(spark: SparkSession, name: str) -> Registered:
    """A table of its own for one call, in the folder that all executors share."""
    name = f"{name}_{uuid.uuid4().hex}"
    return Registered(f"default.{name}", f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/{name}")


def latest_stored_date(spark: SparkSession, sf: str) -> DataFrame:
    """Samples come on three ingest dates; the catalog names the latest, which alone is read."""
    table = _new_table(spark, "samples")
    samples = dt.samples(spark, sf)
    for day in (3, 1, 2):
        part = samples.where(f"CAST(substr(sample_id, 2) AS BIGINT) % 3 + 1 = {day}")
        write_bronze(part, table, date(2025, 1, day))
    return read_latest(spark, table).groupBy("ingest_date", "population_code").agg(
        F.count(F.lit(1)).alias("sample_count")
    )


def stored_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Cohort sizes of some samples, replaced by the sizes of all in two superpopulations."""
    table = _new_table(spark, "sizes")
    keys = ["superpopulation", "population_code"]
    samples = dt.samples(spark, sf)
    size = F.count(F.lit(1)).alias("sample_count")
    some = samples.where("CAST(substr(sample_id, 2) AS BIGINT) % 4 = 0 AND superpopulation <> 'ASIA'")
    upsert_table(some.groupBy(*keys).agg(size), table, keys, keys[:1])
    changed = samples.where("superpopulation IN ('ASIA', 'EUROPE')")
    upsert_table(changed.groupBy(*keys).agg(size), table, keys, keys[:1])
    return read_table(spark, table)


def clustered_calls(spark: SparkSession, sf: str) -> DataFrame:
    """Calls stored by ranges of positions: what each chromosome's files hold within the regions."""
    table = _new_table(spark, "calls")
    calls = dt.variants(spark, sf)
    write_bronze(
        calls, table, date(2025, 1, 1), {"chromosome_part": F.col("chromosome")},
        ("position", "variant_id"), rows_per_file=5000,
    )
    return read_latest(spark, table).groupBy("ingest_date", "chromosome_part").agg(
        F.count(F.lit(1)).alias("call_count"), F.min("position").alias("first_position"),
        F.max("position").alias("last_position"), F.sum("allele_dosage").alias("dosage_sum"),
    )


def _bucketed_variants(spark: SparkSession, sf: str) -> DataFrame:
    table = _new_table(spark, "variants")
    write_variants(dt.variants(spark, sf), table, sample_buckets=64)
    return read_table(spark, table)


def dosage_from_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Dosage per person from facts stored in buckets by sample."""
    return individual_dosage(_bucketed_variants(spark, sf), STUDY)


def joint_impact_from_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Both genes of a person from facts stored in buckets by sample."""
    people = individual_dosage(_bucketed_variants(spark, sf), STUDY, STUDY.joint.genes)
    return build_joint_impact(people, recorded_sizes(spark, sf), STUDY)


def export_populations(spark: SparkSession, sf: str) -> DataFrame:
    return exports.population_export(populations(spark, sf))


def export_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The run description, one row per cohort entry of its map."""
    described = exports.run_metadata(
        populations(spark, sf), allele_frequencies(spark, sf), STUDY, "run", "2025-01-01"
    )
    return described.select(
        "schema_version",
        "snapshot_date",
        "total_variants_analyzed",
        F.explode("populations").alias("population_code", "entry"),
    ).select("*", "entry.*").drop("entry")


def typed_result_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Result rows that arrive as text get their types back."""
    text = dt.table(spark, sf, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS order_id",
        "CASE WHEN l_linenumber = 3 THEN '' ELSE CAST(l_linenumber AS STRING) END AS line",
        "CASE WHEN l_returnflag = 'R' THEN '' ELSE CAST(l_tax AS STRING) END AS tax",
        "CASE WHEN l_linestatus = 'F' THEN '' ELSE CAST(l_discount > 0.05D AS STRING) END "
        "AS discounted",
        "CASE WHEN l_returnflag = 'A' THEN '' ELSE l_returnflag END AS flag",
    )
    typed = exports.typed_rows(text, ["order_id", "line"], ["tax"], ["discounted"])
    return typed.groupBy("line", "tax", "discounted", "flag").agg(
        F.count("order_id").alias("order_count"), F.sum("order_id").alias("order_sum")
    )


def maf_filter(spark: SparkSession, sf: str) -> DataFrame:
    return allele_frequencies(spark, sf, min_maf=0.45)


def top_variants(spark: SparkSession, sf: str) -> DataFrame:
    return top_variants_per_gene(allele_frequencies(spark, sf), 3)


def hemizygous_totals(spark: SparkSession, sf: str) -> DataFrame:
    return allele_frequencies(spark, sf, hemizygous=True)


def upsert_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The strict impact rows replace the stored rows of the same business key."""
    keys = ["drug_name", "gene_symbol", "population_code", "classification_strength"]
    shared = phenotype_distribution(spark, sf)
    recommended = dt.recommendations(spark, sf)
    current = build_drug_impact(shared, recommended, STUDY)
    strong = recommended.where(F.col("classification_strength") == "Strong")
    return upsert(
        current, build_drug_impact(shared, strong, STUDY, STRICT_BASELINE_KEYS), keys
    )


QUERIES: dict[str, Query] = {
    "allele_frequencies": allele_frequencies,
    "gene_assignment": gene_assignment,
    "silver_variants": dt.variants,
    "populations": populations,
    "individual_dosage": individual_dosages,
    "phenotype_distribution": phenotype_distribution,
    "literature_correction": literature_correction,
    "recommendation_flags": recommendation_flags,
    "drug_recommendations": dt.recommendations,
    "curated_override": curated_override,
    "drug_impact": drug_impact,
    "drug_impact_strict": drug_impact_strict,
    "joint_impact": joint_impact,
    "all_impact": all_impact,
    "actionability_ranking": actionability_ranking,
    "clinical_variants": clinical_variants,
    "gene_scope_table": gene_scope_table,
    "gene_scope_check": gene_scope_check,
    "guideline_flatten": guideline_flatten,
    "cross_reference_ids": cross_reference_ids,
    "genotype_melt": genotype_melt,
    "quality_report": quality_report,
    "row_gate": row_counts_gate,
    "dominant_and_mean": dominant_and_mean,
    "knowledge_documents": knowledge_documents,
    "export_frequencies": export_frequencies,
    "export_phenotypes": export_phenotypes,
    "export_populations": export_populations,
    "export_impact": export_impact,
    "export_ranking": export_ranking,
    "document_frequencies": document_frequencies,
    "document_phenotypes": document_phenotypes,
    "artifact_frequencies": artifact_frequencies,
    "artifact_phenotypes": artifact_phenotypes,
    "artifact_impact": artifact_impact,
    "artifact_ranking": artifact_ranking,
    "panel": panel,
    "header_mapping": header_mapping,
    "guidance_records": guidance_records,
    "guidance_shapes": guidance_shapes,
    "frequencies_from_repeated_calls": frequencies_from_repeated_calls,
    "frequencies_from_dates": frequencies_from_dates,
    "gene_assignment_by_bins": gene_assignment_by_bins,
    "latest_stored_date": latest_stored_date,
    "stored_upsert": stored_upsert,
    "impact_ranks": impact_ranks,
    "clustered_calls": clustered_calls,
    "dosage_from_buckets": dosage_from_buckets,
    "joint_impact_from_buckets": joint_impact_from_buckets,
    "export_metadata": export_metadata,
    "typed_result_rows": typed_result_rows,
    "maf_filter": maf_filter,
    "top_variants_per_gene": top_variants,
    "hemizygous_totals": hemizygous_totals,
    "upsert_snapshot": upsert_snapshot,
}
