"""Allele frequencies from several ingest dates, each of which is read once.

A date's calls become a state: per variant and cohort the summed alleles and a bitmap of its samples.
States of several dates are merged by sums and by OR of the bitmaps, so a sample that occurs on
several dates counts once, exactly as if all calls were read again.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscope.operators.frequencies import GROUP_KEYS, rate_frequencies
from cohortscope.study import Study

NUMBERS = "sample_id string, sample_number long"


def number_samples(calls: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(sample_id, sample_number) of the samples that ``known`` has no number for.

    Numbers are consecutive within a partition and above all known ones, so bitmaps of 32,768
    numbers each are few. They are dealt without a sort or a single task: store the result
    before it is used, as another run would deal them otherwise.
    """
    samples = calls.where("sample_id IS NOT NULL").select("sample_id").distinct()
    first = 0
    if known is not None:
        samples = samples.join(known.select("sample_id"), "sample_id", "left_anti")
        first = known.agg(F.coalesce(F.max("sample_number") + 1, F.lit(0))).first()[0]
    return samples.select("sample_id", (F.monotonically_increasing_id() + F.lit(first)).alias("sample_number"))


def frequency_state(calls: DataFrame, numbers: DataFrame) -> DataFrame:
    """Mergeable counts: the group keys present, bucket, samples (a bitmap), allele_count.

    ``numbers`` has one row for each sample. Calls without a sample count their alleles only.
    A hot variant collapses before the exchange: sums and bitmaps are aggregated in each task.
    """
    keys = [k for k in GROUP_KEYS if k in calls.columns]
    known = calls.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).join(numbers, "sample_id", "left")
    return known.selectExpr(
        *keys, "allele_dosage", "bitmap_bucket_number(sample_number) AS bucket",
        "bitmap_bit_position(sample_number) AS place",
    ).groupBy(*keys, "bucket").agg(
        F.expr("bitmap_construct_agg(place) FILTER (WHERE place IS NOT NULL)").alias("samples"),
        F.expr("coalesce(sum(allele_dosage), 0L)").alias("allele_count"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """States of several dates as one; also of states that were merged before."""
    keys = [c for c in states.columns if c in GROUP_KEYS]
    return states.groupBy(*keys, "bucket").agg(
        F.expr("bitmap_or_agg(samples)").alias("samples"), F.sum("allele_count").alias("allele_count")
    )


def frequencies_of_state(state: DataFrame, clinical_variants: DataFrame, study: Study) -> DataFrame:
    """The rows of ``build_allele_frequencies`` from a merged state."""
    keys = [c for c in state.columns if c in GROUP_KEYS]
    counted = state.groupBy(*keys).agg(
        F.sum("allele_count").alias("allele_count"),
        F.expr("2L * coalesce(sum(CASE WHEN bucket IS NOT NULL THEN bitmap_count(samples) END), 0L)").alias(
            "total_alleles"
        ),
    )
    return rate_frequencies(counted, keys, clinical_variants, study)


def add_date(spark: SparkSession, root: str, day: date, calls: DataFrame) -> None:
    """Stores the state of one ingest date; nothing of earlier dates but sample numbers is read.

    A date that is added again is replaced: its samples keep their numbers.
    """
    try:
        known = spark.read.schema(NUMBERS).parquet(f"{root}/samples")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None
    fresh = number_samples(calls, known)
    fresh.write.mode("append").parquet(f"{root}/samples")
    numbers = spark.read.schema(NUMBERS).parquet(f"{root}/samples")
    state = frequency_state(calls, numbers)
    state.write.mode("overwrite").parquet(f"{root}/states/ingest_date={day}")


def stored_frequencies(
    spark: SparkSession, root: str, clinical_variants: DataFrame, study: Study, days: list[date] | None = None
) -> DataFrame:
    """Frequencies over all stored dates, or the given ones, from their states alone."""
    states = spark.read.option("basePath", f"{root}/states")
    if days is None:
        stored = states.parquet(f"{root}/states")
    else:
        stored = reduce(
            DataFrame.unionByName, [states.parquet(f"{root}/states/ingest_date={day}") for day in days]
        )
    return frequencies_of_state(merge_states(stored.drop("ingest_date")), clinical_variants, study)
