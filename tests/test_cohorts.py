from __future__ import annotations

from checks import one, rows

from cohortscope.operators.cohorts import build_pharmacogenes, build_populations

GENES = (
    "pharmgkb_gene_id string, gene_symbol string, ensembl_id string, ncbi_gene_id string, "
    "chromosome string, chromosomal_start string, chromosomal_end string"
)


def test_populations(spark, study):
    cohorts = ["MXL"] * 4 + ["PEL"] * 3 + ["CEU"] * 3 + ["ZZZ", None]
    groups = ["AMR"] * 7 + ["EUR"] * 3 + ["EUR", "EUR"]
    samples = spark.createDataFrame(
        [(f"S{i}", c, g) for i, (c, g) in enumerate(zip(cohorts, groups))] + [("X", "PEL", None)],
        "sample_id string, population_code string, superpopulation string",
    )
    found = build_populations(samples, study)
    assert rows(found, "population_code", "superpopulation", "sample_size") == [
        ("CEU", "EUR", 3), ("MXL", "AMR", 4), ("PEL", "AMR", 3),
    ]
    mxl = one(found, "population_code = 'MXL'")
    assert mxl.region == "Latin America" and mxl.population_name.startswith("Mexican")


def test_unnamed_cohort_keeps_its_code(spark, study):
    from dataclasses import replace

    samples = spark.createDataFrame(
        [("S", "NEW", "EUR")], "sample_id string, population_code string, superpopulation string"
    )
    found = build_populations(samples, replace(study, target_cohorts=("NEW",)))
    assert rows(found) == [("NEW", "NEW", "EUR", "Unknown", 1)]


def test_pharmacogenes(spark, study):
    genes = spark.createDataFrame(
        [
            ("P1", "CYP2C19", "E1", "1557", "chr10", "96522463", "not a number"),
            ("P1b", "CYP2C19", "E1b", "1557", None, None, "7"),
            ("P2", "CYP2D6", "E2", "1565", "chr22", "42522500", "42540000"),
            ("P3", "UNKNOWNGENE", "E3", "9", "chr1", "1", "2"),
        ],
        GENES,
    )
    found = build_pharmacogenes(genes, study)
    assert found.count() == 13  # 12 scope genes, one of them listed twice
    assert rows(
        found.where("gene_symbol = 'CYP2C19'"),
        "ensembl_id", "chromosome", "chromosomal_start", "chromosomal_end",
    ) == [("E1", "chr10", 96522463, None), ("E1b", None, None, 7)]
    assert not one(found, "gene_symbol = 'CYP2D6'").is_in_scope
    tpmt = one(found, "gene_symbol = 'TPMT'")
    assert (tpmt.chromosome, tpmt.chromosomal_start, tpmt.ensembl_id) == ("chr6", 18128556, None)
    assert found.where("gene_symbol = 'UNKNOWNGENE'").isEmpty()
    assert found.where("scope_rationale IS NULL OR scope_rationale = ''").isEmpty()


def test_excluded_gene_without_source_row_has_no_coordinates(spark, study):
    found = build_pharmacogenes(spark.createDataFrame([], GENES), study)
    cyp2d6 = one(found, "gene_symbol = 'CYP2D6'")
    assert found.count() == 12 and cyp2d6.chromosome is None and cyp2d6.chromosomal_end is None
