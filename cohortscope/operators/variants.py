"""Genotype facts: gene assignment, sample attributes, deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.functions import literals
from cohortscope.functions.genome import disjoint_regions, in_regions
from cohortscope.operators.dedup import keep_first, lookup_side
from cohortscope.operators.dimensions import region_table
from cohortscope.schemas import VARIANTS, conform_present
from cohortscope.study import Region, Study

CALL_COLUMNS = (
    "sample_id",
    "variant_id",
    "gene_symbol",
    "chromosome",
    "position",
    "reference_allele",
    "alternate_allele",
    "genotype",
    "allele_dosage",
)
CALL_ORDER = ("chromosome", "position", "reference_allele", "alternate_allele", "genotype")


def assign_genes(df: DataFrame, regions: Sequence[Region]) -> DataFrame:
    """Adds ``gene_symbol`` by position, null outside all regions; no shuffle.

    Overlaps resolve to the region listed last. The regions, a setting, are cut into
    disjoint pieces first, so the broadcast join on the chromosome never multiplies rows.
    """
    return _with_regions(df, regions, "left").select("v.*", "r.gene_symbol")


def keep_regions(df: DataFrame, regions: Sequence[Region]) -> DataFrame:
    """Rows inside some region; the scan gets the span of each chromosome's regions."""
    return _with_regions(df.where(in_regions("chromosome", "position", spans(regions))), regions, "left_semi")


def spans(regions: Sequence[Region]) -> list[Region]:
    """One region per chromosome, from its first start to its last end."""
    return [
        Region("", c, min(r.start for r in own), max(r.end for r in own))
        for c in dict.fromkeys(r.chromosome for r in regions)
        for own in [[r for r in regions if r.chromosome == c]]
    ]


def _with_regions(df: DataFrame, regions: Sequence[Region], how: str) -> DataFrame:
    pieces = F.broadcast(region_table(df.sparkSession, disjoint_regions(regions)))
    hit = F.expr(
        "r.chromosome = v.chromosome AND v.position BETWEEN r.region_start AND r.region_end"
    )
    return df.alias("v").join(pieces.alias("r"), hit, how)


def target_samples(samples: DataFrame, study: Study) -> DataFrame:
    """Samples of the study's cohorts, one row per sample."""
    chosen = samples.where(f"population_code IN ({literals(study.target_cohorts)})")
    return lookup_side(
        chosen.select("sample_id", "population_code", "superpopulation"), "sample_id"
    )


def build_variants(
    calls: DataFrame,
    samples: DataFrame,
    study: Study,
    order_by: Sequence[str] = CALL_ORDER,
    single_calls: bool = False,
) -> DataFrame:
    """Calls inside the study's genes with gene and cohort, one per (sample, variant).

    ``single_calls`` promises that no (sample, variant) repeats, as the bronze table does;
    nothing is deduplicated then. Otherwise calls of samples outside the study go first, so
    they are not shuffled, and copies are removed before the attribute join: the shuffle
    carries no cohort columns, and the join is followed by partial aggregates only, which
    lets adaptive execution split a sample with very many rows. The samples are not hinted;
    Spark broadcasts them when their measured size allows.
    """
    located = assign_genes(calls.where(in_regions("chromosome", "position", spans(study.regions))), study.regions)
    columns = located.columns
    kept = [c for c in CALL_COLUMNS if c in columns]
    order = [c for c in order_by if c in columns]
    located = located.where("gene_symbol IS NOT NULL").select(
        *kept, *[c for c in order if c not in kept]
    )
    targets = target_samples(samples, study)
    if single_calls:
        single = located.select(*kept)
    else:
        wanted = located.join(targets.select("sample_id"), "sample_id", "left_semi")
        # Passed through an expression, so that a hot sample's calls are dealt anew.
        wanted = wanted.withColumn("sample_id", F.expr("concat(sample_id, '')"))
        single = keep_first(wanted, ["sample_id", "variant_id"], order).select(*kept)
    return conform_present(single.join(targets, "sample_id"), VARIANTS)


def require_calls(calls: DataFrame, samples: DataFrame, study: Study) -> None:
    """Raise if no call at all belongs to a target sample, wherever it lies."""
    if calls.join(target_samples(samples, study), "sample_id", "left_semi").isEmpty():
        raise RuntimeError(
            "no variant matches the target samples; check that the genotype calls and the "
            "sample table belong to the same release"
        )
