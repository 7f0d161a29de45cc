"""Genome coordinates: gene lookup, region filters, phenotype categories."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from cohortscope.functions import literal, literals
from cohortscope.study import Region


def any_of(conditions: Iterable[str]) -> str:
    return " OR ".join(f"({c})" for c in conditions) or "FALSE"


def inside(chromosome: str, position: str, region: Region) -> str:
    return (
        f"{chromosome} = {literal(region.chromosome)} "
        f"AND {position} >= {region.start} AND {position} <= {region.end}"
    )


def in_regions(chromosome: str, position: str, regions: Sequence[Region]) -> str:
    """Inside some region, both ends inclusive; reaches a Parquet scan as a filter."""
    return any_of(inside(chromosome, position, r) for r in regions)


def touches_regions(
    chromosome: str, first: str, last: str, regions: Sequence[Region], buffer: int
) -> str:
    """The span first..last overlaps some region widened by a buffer."""
    return any_of(
        f"{chromosome} = {literal(r.chromosome)} AND {first} <= {r.end + buffer} "
        f"AND {last} >= {max(1, r.start - buffer)}"
        for r in regions
    )


def disjoint_regions(regions: Sequence[Region]) -> list[Region]:
    """Cut overlapping regions so that each position keeps only its last listed gene."""
    pieces = []
    for chromosome in dict.fromkeys(r.chromosome for r in regions):
        local = [r for r in regions if r.chromosome == chromosome]
        cuts = sorted({r.start for r in local} | {r.end + 1 for r in local})
        for start, stop in zip(cuts, cuts[1:]):
            covering = [r for r in local if r.start <= start and stop - 1 <= r.end]
            if covering:
                pieces.append(Region(covering[-1].gene, chromosome, start, stop - 1))
    return pieces


def is_key_variant(gene: str, variant: str, key_variants: Mapping[str, Sequence[str]]) -> str:
    """A gene's key variant. The plain list of ids in front passes below a deduplication
    by variant and into the scan; the list of genes prunes partitions."""
    ids = literals(v for listed in key_variants.values() for v in listed)
    pairs = any_of(
        f"{gene} = {literal(g)} AND {variant} IN ({literals(listed)})"
        for g, listed in key_variants.items()
    )
    return f"{variant} IN ({ids}) AND {gene} IN ({literals(key_variants)}) AND ({pairs})"


def category_of(
    gene: str,
    copies: str,
    gene_categories: Mapping[str, Sequence[str]],
    default: Sequence[str],
    unknown: str,
) -> str:
    """Phenotype category for a number of non-functional copies, two or more alike."""

    def pick(levels: Sequence[str]) -> str:
        zero, one, more = (literal(level) for level in levels)
        return (
            f"CASE WHEN {copies} = 0 THEN {zero} WHEN {copies} = 1 THEN {one} "
            f"WHEN {copies} >= 2 THEN {more} ELSE {literal(unknown)} END"
        )

    if not gene_categories:
        return pick(default)
    cases = " ".join(
        f"WHEN {literal(name)} THEN {pick(levels)}" for name, levels in gene_categories.items()
    )
    return f"CASE {gene} {cases} ELSE {pick(default)} END"
