from __future__ import annotations

import json
import os

from checks import rows

from cohortscope.operators import exports
from cohortscope.operators.documents import (
    build_documents,
    dominant_categories,
    mean_frequencies,
)
from cohortscope.operators.upsert import upsert
from cohortscope.schemas import FREQUENCIES, PHENOTYPES, RANKING, columns_of
from cohortscope.sinks.artifacts import export_artifact, write_json

PHENO = (
    "gene_symbol string, population_code string, phenotype_category string, "
    "phenotype_percentage double, snapshot_date date"
)
FREQ = (
    "gene_symbol string, population_code string, variant_id string, allele_frequency double, "
    "snapshot_date date"
)
RANK = (
    "rank_position int, drug_name string, gene_symbol string, population_code string, "
    "classification_strength string, clinical_implication string"
)


def phenotypes(spark):
    return spark.createDataFrame(
        [
            ("G", "PEL", "Poor", 40.0, None), ("G", "PEL", "Normal", 40.0, None),
            ("G", "PEL", "Mid", 20.0, None), ("H", "PEL", "Only", None, None),
        ],
        PHENO,
    )


def frequencies(spark):
    return spark.createDataFrame(
        [("G", "PEL", "v1", 0.1, None), ("G", "PEL", "v2", 0.1005, None), ("G", "PEL", "v3", None, None)],
        FREQ,
    )


def test_dominant_category_and_mean(spark):
    assert rows(dominant_categories(phenotypes(spark))) == [("G", "PEL", "Normal"), ("H", "PEL", "Only")]
    assert rows(mean_frequencies(frequencies(spark))) == [("G", "PEL", 0.2005 / 3)]


def test_documents(spark):
    ranking = spark.createDataFrame(
        [
            (1, "a b/c", "G", "PEL", "Strong", "first"),
            (2, "a b/c", "G", "PEL", None, "second"),
            (3, "x", "Z", "ZZZ", "Optional", None),
            (4, "", "G", "PEL", "Strong", "no drug"),
            (5, "x", None, "PEL", "Strong", "no gene"),
        ],
        RANK,
    )
    found = dict(rows(build_documents(ranking, phenotypes(spark), frequencies(spark)), "path", "document"))
    assert found == {
        "gold/kb-docs/G/PEL/a_b-c.txt": (
            "Gene: G\nPopulation: PEL (Peru)\nDrug: a b/c\nPhenotype: Normal\n"
            "Allele frequency: 6.7%\nActionability: CPIC \nClinical implication: second\n"
        ),
        "gold/kb-docs/Z/ZZZ/x.txt": (
            "Gene: Z\nPopulation: ZZZ (ZZZ)\nDrug: x\nPhenotype: Unknown\n"
            "Allele frequency: 0.0%\nActionability: CPIC Optional\nClinical implication: \n"
        ),
    }


def test_exports_are_projected_and_sorted(spark):
    df = frequencies(spark).selectExpr(
        *[
            c if c in frequencies(spark).columns else f"NULL AS {c}"
            for c in columns_of(FREQUENCIES)
        ]
    )
    found = exports.frequency_export(df, ["v2", "v1"])
    assert [r.variant_id for r in found.collect()] == ["v1", "v2"]
    assert "reference_allele" not in found.columns
    assert exports.frequency_export(df).isEmpty()
    documents = exports.document_frequencies(frequencies(spark)).collect()
    assert [r.variant_id for r in documents] == ["v1", "v2", "v3"]
    categories = exports.document_phenotypes(phenotypes(spark)).collect()
    assert [r.phenotype_category for r in categories] == ["Mid", "Normal", "Poor", "Only"]


def read_lines(path):
    found = []
    for name in sorted(os.listdir(path)):
        if name.endswith(".json"):
            with open(f"{path}/{name}", encoding="utf-8") as lines:
                found += [json.loads(line) for line in lines]
    return found


def test_json_artifacts(spark, folder):
    df = spark.sql(
        "SELECT 'é' AS gene_symbol, NULL AS superpopulation, 5L AS individual_count, "
        "DATE'2025-01-01' AS snapshot_date, 'dropped' AS other"
    )
    assert export_artifact(df, "phenotype_distribution", folder) == 1
    assert read_lines(f"{folder}/phenotype_distribution") == [
        {"gene_symbol": "é", "superpopulation": None, "individual_count": 5,
         "snapshot_date": "2025-01-01"}
    ]
    assert export_artifact(df.where("FALSE"), "phenotype_distribution", folder) == 0
    assert read_lines(f"{folder}/phenotype_distribution") == []
    assert write_json(spark.range(1000).repartition(7), f"{folder}/many") == 1000
    assert set(exports.ARTIFACT_COLUMNS["actionability_ranking"]) == set(columns_of(RANKING))
    assert "data_source" in columns_of(PHENOTYPES)


def test_metadata(spark, study, folder):
    populations = spark.createDataFrame(
        [("PEL", "Peru", "AMR", "Latin America", 85), ("CEU", "Utah", "EUR", "Europe", 99)],
        "population_code string, population_name string, superpopulation string, "
        "region string, sample_size long",
    )
    df = exports.run_metadata(populations, spark.range(42), study, "run-1", "2025-01-01T00:00:00Z")
    write_json(df, f"{folder}/metadata")
    (found,) = read_lines(f"{folder}/metadata")
    assert found["populations"]["PEL"] == {
        "name": "Peru", "region": "Latin America", "superpopulation": "AMR", "sample_size": 85,
    }
    assert (found["total_variants_analyzed"], found["schema_version"]) == (42, "1.0.0")
    assert found["source_versions"]["cpic"] == "v4 PostgREST API"
    assert (found["snapshot_date"], found["pipeline_run_id"]) == ("2025-01-01", "run-1")


def test_typed_rows(spark):
    df = spark.createDataFrame([("5", "0.12345678", "TRUE", "x"), ("", "", "", "")], "a string, b string, c string, d string")
    assert rows(exports.typed_rows(df, ["a"], ["b"], ["c"])) == [
        (None, None, False, None), (5, 0.123457, True, "x"),
    ]


def test_upsert(spark):
    ddl = "k string, x int"
    old = spark.createDataFrame([("a", 1), ("b", 2)], ddl)
    new = spark.createDataFrame([("b", 3), ("c", 4)], ddl)
    assert rows(upsert(old, new, ["k"])) == [("a", 1), ("b", 3), ("c", 4)]
