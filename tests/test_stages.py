"""The whole chain from files to documents on a very small study."""

from __future__ import annotations

import json
import os
from datetime import date

import pytest
from checks import one, rows
from test_sources import record, variant_file, write

from cohortscope.operators.quality import DataQualityError
from cohortscope.plans import stages
from cohortscope.sources.tables import read_table

SAMPLES = {"C1": "CEU", "C2": "CEU", "P1": "PEL", "P2": "PEL", "P3": "PEL"}


@pytest.fixture(scope="module")
def layout(spark, study, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("stages"))
    layout = stages.Layout(f"{base}/lake")
    fill(spark, study, layout, base)
    return layout


def fill(spark, study, layout, base):
    """All stages up to gold, from files in a folder."""
    names = list(SAMPLES)
    calls = f"{base}/calls"
    os.makedirs(calls, exist_ok=True)
    variant_file(
        calls, "10.vcf", names,
        record(96_521_657, "0|0", "0|1", "1|1", "0|1", "0|0"),
        record(96_741_053, "0|0", "0|0", "0|1", "0|0", "0|0"),
    )
    variant_file(calls, "16.vcf", names, record(31_093_954, "0|0", "1|1", "1|1", "0|1", "0|0", chrom="16"))
    panel = write(
        base, "panel.tsv", "sample\tpop\tsuper_pop\tgender",
        *[f"{s}\t{c}\t{'EUR' if c == 'CEU' else 'AMR'}\tfemale" for s, c in SAMPLES.items()],
        "X1\tZZZ\tEUR\tmale",
    )
    annotations = write(
        base, "ca.tsv", "Clinical Annotation ID\tGene\tVariant/Haplotypes\tDrug(s)\tLevel of Evidence",
        "CA1\tCYP2C19\tchr10:96521657\tclopidogrel\t1A",
    )
    genes = write(base, "genes.tsv", "PharmGKB Accession Id\tSymbol", "PA1\tCYP2C19")
    drugs = write(base, "drugs.tsv", "PharmGKB Accession Id\tName", "PA2\tclopidogrel")
    literature = write(base, "lit.tsv", "Variant Annotation ID\tGene", "1\tCYP2C19")
    recommendations = write(
        base, "rec.json",
        json.dumps({"id": 1, "guidelineid": "A", "drugid": "D", "drugrecommendation": "Avoid.",
                    "classification": "Strong", "phenotypes": {"CYP2C19": "Poor Metabolizer"}}),
    )
    guidelines = write(base, "gl.json", json.dumps({"id": "A", "genes": ["CYP2C19"], "version": 2}))
    names_file = write(base, "dn.json", json.dumps({"drugid": "D", "name": "Clopidogrel"}))

    day = date(2025, 1, 1)
    stages.ingest_genotypes(spark, calls, panel, layout, day, study)
    stages.ingest_annotations(
        spark,
        {
            "pharmgkb_clinical_annotations_raw": annotations,
            "pharmgkb_genes_raw": genes,
            "pharmgkb_drugs_raw": drugs,
            "pharmgkb_var_drug_ann_raw": literature,
        },
        layout,
        day,
    )
    stages.ingest_guidance(spark, recommendations, guidelines, names_file, layout, day)
    stages.build_silver(spark, layout, study)
    stages.build_gold(spark, layout, study)


def test_bronze_and_silver(spark, layout):
    assert read_table(spark, layout.bronze("genomes_variants_raw")).count() == 15
    assert rows(read_table(spark, layout.silver("populations")), "population_code", "sample_size") == [
        ("CEU", 2), ("PEL", 3),
    ]
    assert read_table(spark, layout.silver("variants")).count() == 15
    assert read_table(spark, layout.silver("pharmacogenes")).count() == 12
    assert read_table(spark, layout.silver("drug_recommendations")).count() == 53


def test_row_gate(spark, layout):
    stages.check_bronze(spark, layout, {"genomes_variants_raw": 15})
    with pytest.raises(DataQualityError, match="15 rows < 1000"):
        stages.check_bronze(spark, layout)


def test_gold(spark, layout):
    frequencies = read_table(spark, layout.gold("allele_frequencies_by_population"))
    pel = one(frequencies, "variant_id = 'chr10:96521657' AND population_code = 'PEL'")
    assert (pel.allele_frequency, pel.delta_vs_ceu, pel.is_actionable) == (0.5, 0.25, True)
    impact = read_table(spark, layout.gold("drug_impact_summary"))
    assert rows(impact, "drug_name", "gene_symbol", "population_code", "percentage_requiring_change") == [
        ("clopidogrel", "CYP2C19", "PEL", 33.33),
        ("warfarin", "VKORC1", "CEU", 50.0),
        ("warfarin", "VKORC1", "PEL", 66.67),
        ("warfarin", "VKORC1+CYP2C9", "CEU", 50.0),
        ("warfarin", "VKORC1+CYP2C9", "PEL", 33.33),
    ]
    ranking = read_table(spark, layout.gold("actionability_ranking")).orderBy("rank_position")
    assert [r.drug_name for r in ranking.collect()] == ["warfarin", "clopidogrel", "warfarin"]


def test_exports_and_documents(spark, study, layout):
    counts = stages.export_artifacts(spark, layout, study)
    assert counts == {
        "allele_frequencies": 6, "phenotype_distribution": 13, "drug_impact_summary": 5,
        "actionability_ranking": 3,
    }
    metadata = spark.read.json(f"{layout.artifacts()}/metadata").first()
    assert metadata.total_variants_analyzed == 6 and metadata.populations.PEL.sample_size == 3
    stages.publish_documents(spark, layout)
    documents = read_table(spark, f"{layout.artifacts()}/documents")
    assert documents.count() == 3
    assert one(documents, "path LIKE '%clopidogrel%'").document.startswith("Gene: CYP2C19\nPopulation: PEL (Peru)")


def test_a_second_run_gives_the_same_tables(spark, study, layout):
    before = rows(read_table(spark, layout.gold("actionability_ranking")))
    stages.build_silver(spark, layout, study, date(2025, 1, 1))
    stages.build_gold(spark, layout, study)
    assert rows(read_table(spark, layout.gold("actionability_ranking"))) == before


def test_another_study_keeps_the_other_rows(spark, study, layout):
    from dataclasses import replace

    table = layout.gold("allele_frequencies_by_population")
    before = rows(read_table(spark, table))
    only = replace(study, regions=tuple(r for r in study.regions if r.gene == "CYP2C19"))
    stages.build_silver(spark, layout, only, date(2025, 1, 1))
    stages.build_gold(spark, layout, only)
    assert rows(read_table(spark, table)) == before
    stages.build_silver(spark, layout, study, date(2025, 1, 1))


def test_a_panel_that_does_not_match_leaves_silver(spark, study, layout, folder):
    from dataclasses import replace

    before = read_table(spark, layout.silver("variants")).count()
    with pytest.raises(RuntimeError, match="no variant matches"):
        stages.build_silver(spark, layout, replace(study, target_cohorts=("ZZZ",)))
    assert read_table(spark, layout.silver("variants")).count() == before > 0
    stages.build_silver(spark, layout, study, date(2025, 1, 1))


def test_row_gate_on_the_command_line(spark, layout):
    from cohortscope.__main__ import arguments, run

    with pytest.raises(DataQualityError, match="15 rows < 1000"):
        run(spark, arguments(["silver", "--root", layout.root]))
    enough = [f"--minimum={t}=1" for t in (
        "genomes_variants_raw", "pharmgkb_clinical_annotations_raw", "cpic_guidelines_raw",
    )]
    run(spark, arguments(["check", "--root", layout.root, *enough]))


def test_empty_guidance_is_an_error(spark, layout, folder):
    none = write(folder, "r.json", json.dumps({"id": 1, "guidelineid": "unknown"}))
    guidelines = write(folder, "g.json", json.dumps({"id": "A", "genes": ["X"]}))
    drugs = write(folder, "d.json", json.dumps({"drugid": "D", "name": "x"}))
    with pytest.raises(RuntimeError, match="guidance is empty"):
        stages.ingest_guidance(spark, none, guidelines, drugs, stages.Layout(folder), date(2025, 1, 1))


def test_command_line(spark, layout, capsys):
    from cohortscope.__main__ import arguments, run

    run(spark, arguments(["export", "--root", layout.root, "--date", "2025-01-01"]))
    assert "actionability_ranking: 3 rows" in capsys.readouterr().out
    run(spark, arguments(["documents", "--root", layout.root]))
    assert read_table(spark, f"{layout.artifacts()}/documents").count() == 3
