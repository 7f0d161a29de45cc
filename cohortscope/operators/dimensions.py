"""Study settings as small local tables.

Their rows come from the study object, so their size is known before planning.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cohortscope.study import Study

def local_table(
    spark: SparkSession, rows: Sequence[tuple], columns: Sequence[tuple[str, pa.DataType]]
) -> DataFrame:
    """A table of literal rows, planned as a local relation (no job, no Python worker)."""
    arrays = [
        pa.array([row[i] for row in rows], type=kind) for i, (_, kind) in enumerate(columns)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=[n for n, _ in columns]))


def scope_table(spark: SparkSession, study: Study) -> DataFrame:
    return local_table(
        spark,
        study.scope,
        [
            ("gene_symbol", pa.string()),
            ("is_in_scope", pa.bool_()),
            ("scope_rationale", pa.string()),
        ],
    )


def region_table(spark: SparkSession, regions: Sequence) -> DataFrame:
    return local_table(
        spark,
        [(r.gene, r.chromosome, r.start, r.end) for r in regions],
        [
            ("gene_symbol", pa.string()),
            ("chromosome", pa.string()),
            ("region_start", pa.int64()),
            ("region_end", pa.int64()),
        ],
    )


def cohort_table(spark: SparkSession, study: Study) -> DataFrame:
    return local_table(
        spark,
        [(code, name, region) for code, (name, region) in study.cohorts.items()],
        [
            ("population_code", pa.string()),
            ("population_name", pa.string()),
            ("region", pa.string()),
        ],
    )


def curated_table(spark: SparkSession, study: Study) -> DataFrame:
    return local_table(
        spark,
        study.curated,
        [
            ("gene_symbol", pa.string()),
            ("drug_name", pa.string()),
            ("phenotype", pa.string()),
            ("recommendation_text", pa.string()),
            ("classification_strength", pa.string()),
            ("requires_dose_change", pa.bool_()),
            ("requires_alternative", pa.bool_()),
            ("cpic_release_version", pa.string()),
        ],
    )


def literature_table(spark: SparkSession, study: Study) -> DataFrame:
    return local_table(
        spark,
        study.literature,
        [
            ("gene_symbol", pa.string()),
            ("population_code", pa.string()),
            ("allele_frequency", pa.float64()),
            ("data_source", pa.string()),
        ],
    )
