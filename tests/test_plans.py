"""Physical plans, and results when nothing fits a broadcast or one key is very hot."""

from __future__ import annotations

import re
from contextlib import contextmanager
from dataclasses import replace

import pytest
from checks import rows

from cohortscope.operators.frequencies import build_allele_frequencies
from cohortscope.operators.phenotypes import individual_dosage
from cohortscope.operators.variants import build_variants
from cohortscope.plans import driver_tables as dt
from cohortscope.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_product(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    assert not re.search("Python|Cartesian|BatchEval|MapInPandas|ExistingRDD", plan)
    # The curated override matches null keys; its other side is a local table.
    assert "BroadcastNestedLoopJoin" not in plan


def test_facts_are_scanned_once(spark):
    for name in ("allele_frequencies", "phenotype_distribution", "drug_impact", "joint_impact"):
        plan = physical(QUERIES[name](spark, SF_DIR))
        assert plan.count("ReadSchema: struct<l_orderkey") == 1, name


def test_documents_scan_facts_twice(spark):
    """Frequencies and dosages start from the same facts with other filters. In stages both read
    stored tables; in one query the two scans are accepted."""
    for name in ("knowledge_documents", "dominant_and_mean"):
        plan = physical(QUERIES[name](spark, SF_DIR))
        assert plan.count("ReadSchema: struct<l_orderkey") >= 2, name


def test_fillers_of_the_ranking_are_an_ordered_limit(spark):
    assert "TakeOrderedAndProject(limit=50" in physical(QUERIES["actionability_ranking"](spark, SF_DIR))


def test_options_change_rows(spark):
    """The test tables are such that each option and filter has something to do."""
    plain = QUERIES["allele_frequencies"](spark, SF_DIR)
    columns = ["variant_id", "population_code", "total_alleles"]
    assert rows(QUERIES["hemizygous_totals"](spark, SF_DIR), *columns) != rows(plain, *columns)
    rare = QUERIES["maf_filter"](spark, SF_DIR)
    assert 0 < rare.count() < plain.count()
    assert rare.where("delta_vs_ceu IS NULL").count() <= plain.where("delta_vs_ceu IS NULL").count()
    cohorts = QUERIES["populations"](spark, SF_DIR)
    everyone = dt.samples(spark, SF_DIR).select("population_code").distinct()
    assert cohorts.count() < everyone.count()


def test_copies_are_merged_before_the_exchange(spark):
    plan = re.sub(r"#\d+L?", "", physical(QUERIES["silver_variants"](spark, SF_DIR)))
    merged = r"Aggregate\(key=\[sample_id, variant_id\], functions=\[{}"
    assert re.search(
        merged.format(r"min\(") + r".*Exchange hashpartitioning\(sample_id, variant_id,"
        r".*" + merged.format(r"partial_min\("),
        plan,
        re.DOTALL,
    )


def test_scan_gets_the_region_filter(spark, study, folder):
    spark.range(100).selectExpr(
        "'chr10' AS chromosome", "id + 96510000 AS position", "concat('S', id) AS sample_id",
        "concat('v', id) AS variant_id", "'A' AS reference_allele", "'G' AS alternate_allele",
        "'0|1' AS genotype", "1 AS allele_dosage", "'unused' AS info_payload",
    ).write.parquet(f"{folder}/calls")
    calls = spark.read.parquet(f"{folder}/calls")
    samples = spark.sql(
        "SELECT 'S1' AS sample_id, 'MXL' AS population_code, 'AMR' AS superpopulation"
    )
    variants = build_variants(calls, samples, study)
    with settings(spark, spark__sql__maxMetadataStringLength="100000"):
        (scan,) = [line for line in physical(variants).splitlines() if "FileScan" in line]
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", scan).group(1)
        key = physical(individual_dosage(variants, study))
    assert "EqualTo(chromosome,chr10)" in pushed and "GreaterThanOrEqual(position" in pushed
    assert "info_payload" not in scan
    assert "In(variant_id, [chr10:96521657" in key


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


@pytest.mark.parametrize(
    "name",
    ["silver_variants", "allele_frequencies", "actionability_ranking", "guideline_flatten",
     "genotype_melt", "gene_scope_table", "knowledge_documents"],
)
def test_same_rows_without_broadcasts(spark, name):
    expected = rows(QUERIES[name](spark, SF_DIR))
    with settings(spark, **NO_BROADCAST):
        assert rows(QUERIES[name](spark, SF_DIR)) == expected


def hot_calls(spark, people, copies):
    """A third of all rows belongs to one sample, a third to copies of one call."""
    ordinary = f"""SELECT concat('S', id % {people}) AS sample_id, id div {people} % 400 AS site,
                          CAST(id % 3 AS INT) AS allele_dosage, id AS tie
                   FROM range({copies})"""
    one_sample = f"SELECT 'HOT', id, CAST(id % 3 AS INT), id FROM range({copies})"
    one_call = f"SELECT 'COPY', 7, CAST(id % 3 AS INT), id FROM range({copies})"
    return spark.sql(
        f"{ordinary} UNION ALL {one_sample} UNION ALL {one_call}"
    ).selectExpr(
        "sample_id", "concat('chr10:', 96520000 + site) AS variant_id", "'chr10' AS chromosome",
        "96520000 + site AS position", "'A' AS reference_allele", "'G' AS alternate_allele",
        "element_at(array('0|0', '0|1', '1|1'), allele_dosage + 1) AS genotype",
        "allele_dosage", "tie",
    )


def test_hot_sample_and_hot_copies(spark, study):
    people, copies = 50, 60_000
    calls = hot_calls(spark, people, copies)
    samples = spark.sql(
        f"""SELECT concat('S', id) AS sample_id, IF(id % 2 = 0, 'CEU', 'MXL') AS population_code,
                   'X' AS superpopulation FROM range({people})
            UNION ALL SELECT 'HOT', 'MXL', 'X' UNION ALL SELECT 'COPY', 'CEU', 'X'"""
    )
    flags = spark.createDataFrame([], "variant_rsid string, is_actionable boolean")

    variants = build_variants(calls, samples, study, ("tie",))
    assert variants.count() == people * 400 + copies + 1
    expected = rows(build_allele_frequencies(variants, flags, study, single_calls=True))
    with settings(
        spark, **NO_BROADCAST,
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
    ):
        split = build_allele_frequencies(variants, flags, study, single_calls=True)
        assert rows(split) == expected
        assert "SortMergeJoin(skew=true)" in physical(split)


def test_single_calls_agree_with_distinct_counts(spark):
    variants = dt.variants(spark, SF_DIR)
    flags = spark.createDataFrame([], "variant_rsid string, is_actionable boolean")
    fast = build_allele_frequencies(variants, flags, dt.STUDY, single_calls=True)
    assert rows(fast) == rows(build_allele_frequencies(variants, flags, dt.STUDY))
    other = replace(dt.STUDY, baseline="NATION_3")
    compared = build_allele_frequencies(variants, flags, other, single_calls=True)
    assert compared.where("population_code = 'NATION_3' AND delta_vs_ceu <> 0").isEmpty()
