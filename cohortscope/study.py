"""Study settings: the constants one run of the operators depends on.

They are configuration (a few dozen values), so operators turn them into literal
expressions instead of joins: the filters then reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from cohortscope import domain


@dataclass(frozen=True)
class Region:
    gene: str
    chromosome: str
    start: int
    end: int


@dataclass(frozen=True)
class JointDosing:
    """A drug whose dose depends on the categories of two genes."""

    drug: str = domain.JOINT_DRUG
    genes: tuple[str, str] = domain.JOINT_GENES
    strength: str = domain.JOINT_STRENGTH
    doses: Mapping[tuple[str, str], str] = field(default_factory=lambda: domain.JOINT_DOSES)
    standard: str = domain.STANDARD_DOSE

    @property
    def label(self) -> str:
        return "+".join(self.genes)


@dataclass(frozen=True)
class Study:
    snapshot_date: date
    baseline: str = domain.BASELINE_COHORT
    cohorts: Mapping[str, tuple[str, str]] = field(default_factory=lambda: domain.COHORTS)
    target_cohorts: tuple[str, ...] = tuple(domain.COHORTS)
    regions: tuple[Region, ...] = tuple(
        Region(gene, *where) for gene, where in domain.GENE_REGIONS.items()
    )
    region_buffer: int = domain.REGION_BUFFER_BP
    key_variants: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: domain.KEY_VARIANTS
    )
    inverted_genes: tuple[str, ...] = domain.INVERTED_GENES
    gene_categories: Mapping[str, tuple[str, str, str]] = field(
        default_factory=lambda: domain.GENE_CATEGORIES
    )
    default_categories: tuple[str, str, str] = domain.DEFAULT_CATEGORIES
    literature: tuple[tuple[str, str, float, str], ...] = domain.LITERATURE_FREQUENCIES
    observed_source: str = domain.OBSERVED_SOURCE
    scope: tuple[tuple[str, bool, str], ...] = domain.GENE_SCOPE
    curated: tuple[tuple, ...] = tuple(domain.curated_guidance())
    joint: JointDosing = field(default_factory=JointDosing)
    strength_weights: Mapping[str, float] = field(
        default_factory=lambda: domain.STRENGTH_WEIGHTS
    )

    @property
    def scope_genes(self) -> list[str]:
        return sorted(symbol for symbol, in_scope, _ in self.scope if in_scope)
