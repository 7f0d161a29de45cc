"""The driver's commerce-shaped tables seen as genotype, cohort and guidance tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from cohortscope.functions import literals
from cohortscope.operators.guidance import build_recommendations
from cohortscope.operators.variants import build_variants, keep_regions
from cohortscope.study import JointDosing, Region, Study

STUDY = Study(
    snapshot_date=date(2025, 1, 1),
    baseline="NATION_0",
    cohorts={"NATION_0": ("Cohort Zero", "North"), "NATION_7": ("Cohort Seven", "South")},
    target_cohorts=tuple(f"NATION_{i}" for i in range(22)),
    regions=(
        Region("G1", "chr1", 0, 299),
        Region("G4", "chr2", 50, 199),  # overlaps the next one, which wins
        Region("G2", "chr2", 100, 699),
        Region("G3", "chr3", 0, 799),
        Region("G4", "chr4", 200, 999),
    ),
    region_buffer=50,
    key_variants={
        "G1": ("chr1:0", "chr1:125"),
        "G2": ("chr2:150",),
        "G3": ("chr3:50", "chr3:175", "chr3:300"),
        "G4": ("chr4:200",),
    },
    inverted_genes=("G4",),
    gene_categories={"G2": ("Normal", "Deficient", "Deficient")},
    default_categories=("Normal", "Intermediate", "Poor"),
    literature=(("G3", "NATION_7", 0.031, "literature"),),
    observed_source="observed",
    scope=(
        ("G1", True, "first study gene"),
        ("G2", True, "second study gene"),
        ("G3", True, "third study gene"),
        ("G4", True, "fourth study gene"),
        ("G5", False, "no region"),
    ),
    curated=(
        ("G1", "red widget", "Poor", "Curated text.", "Strong", True, False, "c1"),
        ("G2", "curated only", "Deficient", "Curated text.", "Moderate", False, True, "c1"),
        ("G4", "small ring", "Normal", "Curated text.", "Optional", False, False, "c1"),
    ),
    joint=JointDosing(
        drug="joint drug",
        genes=("G1", "G2"),
        strength="Strong",
        doses={
            ("Intermediate", "Deficient"): "low",
            ("Poor", "Normal"): "low",
            ("Poor", "Deficient"): "low",
        },
    ),
)

PHRASES = (
    "Initiate therapy with the standard dose.",
    "Reduce the starting amount by half.",
    "AVOID use; select another drug.",
    "Consider a dose adjustment and an alternative.",
    "No reason to avoid this drug.",
    "Use 50% of the usual amount.",
    "Titration may be needed.",
    "Substitute where possible.",
)
STRENGTHS = ("Strong", "Moderate", "Optional", "", "No Recommendation ", None, "Strong")
PHENOTYPES = ("Normal", "Intermediate", "Poor", "Deficient")
EVIDENCE = ("1A", "1B", "2A", "2B", "3", None)

FACT_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
)


# The columns used here. With a declared schema, opening a table reads no file footer.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string"
    ),
    "events": "event_id bigint, user_id bigint, event_type string, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def pick(choices, index: str) -> str:
    return f"element_at(array({literals(choices)}), CAST({index} AS INT) + 1)"


def sites(lineitem: DataFrame) -> DataFrame:
    """Order lines with chromosome, position, variant id and dosage."""
    chromosome = pick([f"chr{i}" for i in range(1, 6)], "l_partkey % 5")
    return lineitem.selectExpr(
        "*",
        f"{chromosome} AS chromosome",
        "l_partkey % 40 * 25 AS position",
        "CAST(l_quantity AS INT) % 3 AS allele_dosage",
    )


def spread_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines at positions all over five chromosomes."""
    chromosome = pick([f"chr{i}" for i in range(1, 6)], "l_partkey % 5")
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{chromosome} AS chromosome", "(l_partkey * 131 + l_suppkey * 7919) % 3000000 AS position"
    )


def part_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region for each part, from some bases to a million long."""
    chromosome = pick([f"chr{i}" for i in range(1, 6)], "p_partkey % 5")
    length = "CAST(power(10, p_partkey % 7) AS BIGINT) * (1 + p_size % 9) div 9"
    return table(spark, sf_dir, "part").selectExpr(
        "concat('P', p_partkey) AS gene_symbol",
        f"{chromosome} AS chromosome",
        "(p_partkey * 104729) % 3000000 AS region_start",
        f"(p_partkey * 104729) % 3000000 + {length} AS region_end",
        "p_partkey * 7 % 1009 * 1000000 + p_partkey AS listed",
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genotype facts: each order line is a call of its customer.

    Lines outside the study's regions are dropped before the order join, as a region
    fetch would, so they are never shuffled.
    """
    placed = keep_regions(sites(table(spark, sf_dir, "lineitem")), STUDY.regions)
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey")
    return placed.join(orders, "l_orderkey").selectExpr(
        "chromosome",
        "position",
        "concat(chromosome, ':', position) AS variant_id",
        "'A' AS reference_allele",
        "'G' AS alternate_allele",
        "concat('S', o_custkey) AS sample_id",
        # Some calls have one allele.
        "CASE WHEN l_suppkey % 10 = 0 AND allele_dosage < 2 THEN CAST(allele_dosage AS STRING) "
        f"ELSE {pick(('0|0', '0|1', '1|1'), 'allele_dosage')} END AS genotype",
        "allele_dosage",
        *FACT_ORDER,
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    region = table(spark, sf_dir, "region")
    return (
        customer.join(nation, "n_nationkey")
        .join(region, "r_regionkey")
        .selectExpr(
            "concat('S', c_custkey) AS sample_id",
            "n_name AS population_code",
            "r_name AS superpopulation",
            "CAST(NULL AS STRING) AS sex",
            "CAST(NULL AS STRING) AS family_id",
        )
    )


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_variants(calls(spark, sf_dir), samples(spark, sf_dir), STUDY, FACT_ORDER)


GENE_OF_PART = "concat('G', p_partkey % 5 + 1) AS gene_symbol"


def guidance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "concat('GL', p_partkey) AS guideline_id",
        GENE_OF_PART,
        "CASE WHEN p_partkey % 2 = 1 THEN concat('  ', upper(p_name), ' ') ELSE p_name END "
        "AS drug_name",
        f"{pick(PHENOTYPES, 'p_size % 4')} AS phenotype",
        "'' AS activity_score",
        f"{pick(PHRASES, '(p_partkey + p_size) % 8')} AS recommendation_text",
        f"{pick(STRENGTHS, 'p_partkey % 7')} AS classification_strength",
        "concat('v', p_size % 3) AS cpic_release_version",
    )


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_recommendations(guidance(spark, sf_dir), STUDY)


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "concat('CA', p_partkey) AS clinical_annotation_id",
        "concat('chr', p_partkey % 5 + 1, ':', p_partkey % 40 * 25) AS variant_or_haplotype",
        GENE_OF_PART,
        "CASE WHEN p_size <> 1 THEN concat(p_name, '; ', p_type, ' , ', p_brand) END "
        "AS drug_names",
        "CASE WHEN p_size % 2 = 0 THEN 'Dosage' END AS phenotype_categories",
        f"CASE WHEN p_partkey % 40 < 20 THEN {pick(EVIDENCE, 'p_size % 6')} ELSE '3' END "
        "AS evidence_level",
        "CASE WHEN p_size % 5 <> 0 THEN repeat(concat(p_name, ' ', p_type, '. '), 30) END "
        "AS annotation_text",
    )


def gene_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gene coordinates; some ids are in no scope list, some numbers are not numbers."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('G', p_partkey % 4 * 2 + 1) AS gene_symbol",
        "concat('E', p_partkey) AS ensembl_id",
        "CASE WHEN p_size % 2 = 0 THEN CAST(p_partkey AS STRING) END AS ncbi_gene_id",
        "'chr9' AS chromosome",
        "CASE WHEN p_size % 4 = 0 THEN 'n/a' ELSE CAST(p_size AS STRING) END "
        "AS chromosomal_start",
        "CASE WHEN p_size % 5 = 0 THEN '12.5' ELSE CAST(p_size + p_partkey AS STRING) END "
        "AS chromosomal_end",
    )


def raw_guidelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('GL', s_suppkey) AS id",
        "s_name AS name",
        "CASE WHEN s_suppkey % 4 = 0 THEN CAST(array() AS ARRAY<STRING>) "
        "ELSE array('G1', 'g2') END AS genes",
        "CAST(NULL AS STRING) AS url",
        "CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey % 5 AS STRING) END AS version",
    )


def raw_drugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "concat('D', p_partkey) AS drugid", "CASE WHEN p_size = 2 THEN '' ELSE p_name END AS name"
    )


def raw_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = pick(("Normal", "Poor", ""), "k % 3")
    nested = f"""concat('{{"G1":"', {first}, '","G2":"P', k % 4, '"}}')"""
    return (
        table(spark, sf_dir, "events")
        .selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
        .selectExpr(
            "CAST(event_id AS STRING) AS id",
            "concat('GL', user_id) AS guidelineid",
            "concat('D', event_id % 3000) AS drugid",
            "concat('text for ', event_type) AS drugrecommendation",
            "CASE WHEN k % 2 = 0 THEN 'Strong' END AS classification",
            f"from_json({nested}, 'map<string,string>') AS phenotypes",
            "CASE WHEN k % 3 = 0 THEN map('G1', CAST(k AS STRING)) END AS activityscore",
            "CAST(NULL AS STRING) AS comments",
        )
    )


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, line) guidance as JSON lines, three in eleven of another shape than declared."""
    scores = pick(('1.0', '"n/a"', "true", "[1, 2.50]", "null"), "event_id % 5")
    kinds = "event_id % 11"
    return (
        table(spark, sf_dir, "events")
        .selectExpr(
            "concat('part', user_id % 3) AS file", "event_id", f"{scores} AS score",
            f"""concat('{{"id": ', event_id, ', "guidelineid": "GL', user_id,
                '", "phenotypes": {{"G1": "', event_type, '", "G2": ', {scores}, '}}') AS head""",
        )
        .selectExpr(
            "file",
            f"""CASE {kinds} WHEN 0 THEN concat(head, ', "activityscore": [', score, ']}}')
                WHEN 1 THEN head
                WHEN 2 THEN concat('[', head, '}}, {{"id": -', event_id + 1, '}}]')
                WHEN 3 THEN CAST(event_id AS STRING)
                WHEN 4 THEN concat(head, ', "activityscore": null}}')
                ELSE concat(head, ', "activityscore": {{"G1": ', score, '}}}}') END AS line""",
        )
    )


CALL_TEXTS = ("0|0:7", "0|1:7", "1|1:7", "./.:0", "0/1:3", "1:9")


def variant_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as variant file lines: one record per vector, one sample per dimension."""
    call = pick(CALL_TEXTS, "floor(abs(x) * 100) % 6")
    return table(spark, sf_dir, "embeddings").selectExpr(
        "CAST(vec_id % 2 AS INT) AS header",
        f"""concat_ws('\\t',
            label % 5 + 1,
            vec_id * 3,
            CASE WHEN vec_id % 7 = 0 THEN concat('rs', vec_id % 50) ELSE '.' END,
            'AC',
            CASE WHEN vec_id % 11 = 1 THEN 'G,T' WHEN vec_id % 13 = 1 THEN '.' ELSE 'G' END,
            CASE WHEN vec_id % 3 = 0 THEN '.' ELSE CAST(vec_id % 100 AS STRING) END,
            CASE vec_id % 4 WHEN 0 THEN '.' WHEN 1 THEN 'q10;s50' ELSE 'PASS' END,
            'AF=0.1',
            'GT:DP',
            array_join(transform(embedding, x -> {call}), '\\t')) AS value""",
    )


def line_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "embeddings")
        .selectExpr("explode(sequence(0, size(embedding) - 1)) AS column_index")
        .distinct()
        .selectExpr(
            "explode(array(0, 1)) AS header",
            "column_index",
            "concat('P', column_index) AS sample_id",
        )
    )


def drug_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "CASE WHEN p_size <> 3 THEN concat('ATC:', p_brand, ', RxNorm:', p_partkey, "
        "':x,Other:1,ATC:', p_type, ',RxNormX:7') END AS _cross_references",
    )
