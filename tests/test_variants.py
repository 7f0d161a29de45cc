from __future__ import annotations

import random
from dataclasses import replace

import pytest
from checks import rows

from cohortscope import domain
from cohortscope.functions.genome import disjoint_regions
from cohortscope.operators import variants as v
from cohortscope.operators.dedup import keep_first
from cohortscope.study import Region

CALLS = (
    "sample_id string, variant_id string, chromosome string, position long, "
    "reference_allele string, alternate_allele string, genotype string, allele_dosage int"
)


def genes(spark, regions, places):
    df = spark.createDataFrame(places, "chromosome string, position long")
    return rows(v.assign_genes(df, regions))


def test_positions_of_the_study_genes(spark, study):
    places = [
        ("chr10", 96_570_000), ("chr10", 96_720_000), ("chr12", 21_340_000), ("chr1", 97_900_000),
        ("chrX", 153_780_000), ("chr1", 1_000_000), ("chr1", 96_570_000), ("chr99", 1),
    ]
    found = {(c, p): g for c, p, g in genes(spark, study.regions, places)}
    assert [found[p] for p in places] == [
        "CYP2C19", "CYP2C9", "SLCO1B1", "DPYD", "G6PD", None, None, None,
    ]


def test_every_region_includes_both_ends(spark, study):
    for shift, inside in ((0, True), (1, False)):
        places = [(r.chromosome, r.start - shift) for r in study.regions]
        places += [(r.chromosome, r.end + shift) for r in study.regions]
        found = genes(spark, study.regions, places)
        assert all((g is not None) == inside for _, _, g in found)


def test_key_variants_lie_in_their_gene(spark, study):
    places = [
        (k.split(":")[0], int(k.split(":")[1])) for ids in study.key_variants.values() for k in ids
    ]
    found = {f"{c}:{p}": g for c, p, g in genes(spark, study.regions, places)}
    assert found == {k: gene for gene, ids in study.key_variants.items() for k in ids}


OVERLAPPING = (
    Region("A", "chr1", 0, 100),
    Region("B", "chr1", 50, 60),
    Region("C", "chr1", 55, 150),
    Region("A", "chr2", 10, 20),
    Region("D", "chr2", 21, 30),
    Region("E", "chr2", 5, 12),
)


def last_listed(regions, chromosome, position):
    hits = [r.gene for r in regions if r.chromosome == chromosome and r.start <= position <= r.end]
    return hits[-1] if hits else None


def test_overlaps_resolve_to_the_last_region(spark):
    places = [(c, p) for c in ("chr1", "chr2", "chr3") for p in range(-1, 160)] + [("chr1", None)]
    expected = sorted(
        ((c, p, last_listed(OVERLAPPING, c, p) if p is not None else None) for c, p in places),
        key=str,
    )
    assert sorted(genes(spark, OVERLAPPING, places), key=str) == expected
    df = spark.createDataFrame(places, "chromosome string, position long")
    assert v.keep_regions(df, OVERLAPPING).count() == sum(1 for r in expected if r[2])


def test_two_hundred_regions(spark):
    regions = [Region(f"G{i}", f"chr{i % 7}", i * 50, i * 50 + 60) for i in range(200)]
    places = [(f"chr{i % 7}", i * 23) for i in range(500)]
    expected = sorted(((c, p, last_listed(regions, c, p)) for c, p in places), key=str)
    assert sorted(genes(spark, regions, places), key=str) == expected


def test_disjoint_pieces_never_overlap():
    pieces = disjoint_regions(OVERLAPPING)
    for a in pieces:
        for b in pieces:
            if a is not b and a.chromosome == b.chromosome:
                assert a.end < b.start or b.end < a.start


def test_keep_first_has_a_defined_survivor(spark):
    pick = random.Random(1)
    data = [(pick.randrange(5), pick.randrange(3), pick.randrange(50)) for _ in range(500)]
    df = spark.createDataFrame(data, "k int, o int, x int")
    expected = sorted(min(r for r in data if r[0] == k) for k in {r[0] for r in data})
    for parts in (1, 7):
        assert rows(keep_first(df.repartition(parts), ["k"], ["o"])) == [
            (k, o, x) for k, o, x in sorted(expected, key=lambda r: [str(c) for c in r])
        ]


def test_keep_first_matches_null_keys_and_bare_keys(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, x int")
    assert rows(keep_first(df, ["k"])) == [(None, 1), ("a", 3)]
    assert rows(keep_first(df.select("k"), ["k"])) == [(None,), ("a",)]


def call(sample, variant, position, dosage, chromosome="chr10", genotype="0|1"):
    return (sample, variant, chromosome, position, "G", "A", genotype, dosage)


def test_variants_keep_target_samples_in_genes_once(spark, study):
    calls = spark.createDataFrame(
        [
            call("S1", "chr10:96521657", 96_521_657, 1, genotype="0|1"),
            call("S1", "chr10:96521657", 96_521_657, 0, genotype="0|0"),
            call("S2", "chr10:96521657", 96_521_657, 2, genotype="1|1"),
            call("S3", "chr10:96521657", 96_521_657, 1),
            call("S1", "chr10:5", 5, 1),
            call("S9", "chr10:96521657", 96_521_657, 1),
        ],
        CALLS,
    )
    samples = spark.createDataFrame(
        [
            ("S1", "MXL", "AMR"), ("S2", "CEU", "EUR"), ("S3", "ZZZ", "EUR"),
            ("S2", "CEU", "EUR"),
        ],
        "sample_id string, population_code string, superpopulation string",
    )
    found = v.build_variants(calls, samples, study)
    assert found.columns == [c.split()[0] for c in v.VARIANTS.split(", ")]
    assert rows(found, "sample_id", "gene_symbol", "genotype", "population_code") == [
        ("S1", "CYP2C19", "0|0", "MXL"), ("S2", "CYP2C19", "1|1", "CEU"),
    ]
    v.require_calls(calls.where("position = 5"), samples, study)
    with pytest.raises(RuntimeError, match="target samples"):
        v.require_calls(calls, samples.where("FALSE"), study)


def test_study_constants(study):
    assert len(study.target_cohorts) == 26
    assert {"MXL", "PEL", "CLM", "PUR", "CEU"} <= set(study.target_cohorts)
    assert study.key_variants["SLCO1B1"] == ("chr12:21331549",)
    assert study.key_variants["CYP3A5"] == ("chr7:99270539",)
    assert "CYP3A5" in study.inverted_genes
    assert study.scope_genes == sorted(r.gene for r in study.regions)
    assert len(study.curated) == 52 and len({r[:3] for r in study.curated}) == 52
    assert set(domain.COHORT_COUNTRIES) == set(study.cohorts)
    assert replace(study, baseline="PEL").baseline == "PEL"
