"""Frequencies merged from the states of ingest dates equal a full recomputation."""

from __future__ import annotations

import os
import random
from datetime import date

import pytest
from checks import rows

from cohortscope.operators.frequencies import build_allele_frequencies
from cohortscope.operators.frequency_state import (
    add_date, frequency_state, merge_states, number_samples, stored_frequencies,
)

CALLS = (
    "sample_id string, variant_id string, gene_symbol string, chromosome string, position long, "
    "reference_allele string, alternate_allele string, genotype string, allele_dosage int, "
    "population_code string, superpopulation string"
)
DAYS = [date(2025, 1, d) for d in (1, 2, 3)]


def made(day):
    pick = random.Random(day)
    out = []
    for _ in range(600):
        site, sample = pick.randrange(12), pick.randrange(80)
        cohort = "CEU" if sample % 3 == 0 else f"C{sample % 3}"
        out.append((f"S{sample}", f"rs{site}", "G", "chr1", site, "A", "G", "0|1", pick.choice([0] * 9 + [1, 2]), cohort, "X"))
    odd = (None, "rs1", "G", "chr1", 1, "A", "G", "0|1", 2, "CEU", "X")
    return out + [odd, out[0], out[1], (*out[2][:8], None, *out[2][9:]), (*out[3][:9], None, "X")]


@pytest.fixture(scope="module")
def clinical(spark):
    return spark.createDataFrame([("rs1", True)], "variant_rsid string, is_actionable boolean")


def test_dates_equal_the_whole(spark, study, clinical, folder):
    for day in DAYS:
        add_date(spark, folder, day, spark.createDataFrame(made(day.day), CALLS))
    every = spark.createDataFrame([r for day in DAYS for r in made(day.day)], CALLS)
    expected = rows(build_allele_frequencies(every, clinical, study))
    assert rows(stored_frequencies(spark, folder, clinical, study)) == expected and expected
    # One date again: replaced, with the samples' numbers as they were.
    add_date(spark, folder, DAYS[1], spark.createDataFrame(made(2), CALLS))
    assert rows(stored_frequencies(spark, folder, clinical, study)) == expected
    numbers = spark.read.parquet(f"{folder}/samples")
    assert numbers.count() == numbers.select("sample_id").distinct().count()
    assert numbers.select("sample_number").distinct().count() == numbers.count()
    some = spark.createDataFrame([r for day in DAYS[:2] for r in made(day.day)], CALLS)
    assert rows(stored_frequencies(spark, folder, clinical, study, DAYS[:2])) == rows(
        build_allele_frequencies(some, clinical, study)
    )


def test_a_new_date_reads_only_itself(spark, folder):
    add_date(spark, folder, DAYS[0], spark.createDataFrame(made(1), CALLS))
    state = f"{folder}/states/ingest_date={DAYS[0]}"
    before = sorted(os.listdir(state))
    for name in before:
        os.truncate(f"{state}/{name}", 0)  # unreadable from here on
    add_date(spark, folder, DAYS[1], spark.createDataFrame(made(2), CALLS))
    assert sorted(os.listdir(state)) == before


def test_merging_in_steps(spark):
    parts = [spark.createDataFrame(made(d), CALLS) for d in (1, 2, 3)]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    numbers = spark.createDataFrame(number_samples(union).collect(), "sample_id string, sample_number long")
    states = [frequency_state(p, numbers) for p in parts]
    once = merge_states(states[0].unionByName(states[1]).unionByName(states[2]))
    steps = merge_states(merge_states(states[0].unionByName(states[1])).unionByName(states[2]))
    assert rows(once) == rows(steps)
    assert merge_states(states[0].limit(0)).count() == 0
