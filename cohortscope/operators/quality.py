"""Checks on tables: required columns, nulls, gene scope, row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.functions import literal
from cohortscope.operators.dimensions import scope_table
from cohortscope.schemas import BRONZE_COLUMNS
from cohortscope.study import Study


class DataQualityError(RuntimeError):
    """A table does not have the declared shape."""


class OutOfScopeGeneError(ValueError):
    """A gene is unknown to the study or excluded from it."""


def missing_columns(df: DataFrame, table: str) -> list[str]:
    return sorted(set(BRONZE_COLUMNS.get(table, {})) - set(df.columns))


def null_counts(df: DataFrame, table: str) -> DataFrame:
    """(table_name, column_name, null_count) of the required columns, in one pass."""
    required = [
        name
        for name, nullable in BRONZE_COLUMNS.get(table, {}).items()
        if not nullable and name in df.columns
    ]
    return count_nulls(df, table, required)


def count_nulls(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    counted = df.agg(*[F.expr(f"count_if({c} IS NULL)").alias(c) for c in columns])
    entries = ", ".join(
        f"named_struct('column_name', '{c}', 'null_count', {c})" for c in columns
    )
    return counted.selectExpr(f"inline(array({entries}))").selectExpr(
        f"{literal(table)} AS table_name", "column_name", "null_count"
    )


def violations(df: DataFrame, table: str) -> DataFrame:
    return null_counts(df, table).where("null_count > 0")


def required_columns(df: DataFrame, table: str) -> list[str]:
    """Columns that must not be null; raises if declared columns are missing."""
    missing = missing_columns(df, table)
    if missing:
        raise DataQualityError(
            f"table {table!r}: missing required columns {missing}; got {sorted(df.columns)}"
        )
    return [name for name, nullable in BRONZE_COLUMNS.get(table, {}).items() if not nullable]


def validate(df: DataFrame, table: str) -> None:
    """Raise, naming every missing column or every required column with nulls."""
    if not required_columns(df, table):
        return
    found = violations(df, table).orderBy("column_name").collect()
    if found:
        listed = ", ".join(f"{r.column_name!r}: {r.null_count} null value(s)" for r in found)
        raise DataQualityError(f"table {table!r}: non-nullable columns contain nulls: {listed}")


def guarded(df: DataFrame, table: str) -> DataFrame:
    """The same rows, failing as soon as a required column is null.

    The check sits in the projection of the first required column, so it sees exactly
    the rows that are written and costs no extra pass.
    """
    required = required_columns(df, table)
    if not required:
        return df
    null = " OR ".join(f"{c} IS NULL" for c in required)
    complaint = literal(f"table {table!r}: a non-nullable column is null")
    first = required[0]
    return df.withColumn(
        first, F.expr(f"CASE WHEN {null} THEN raise_error({complaint}) ELSE {first} END")
    )


def scope_status(genes: DataFrame, study: Study) -> DataFrame:
    """Adds ``scope_status`` (in_scope, excluded, unknown) and the rationale."""
    scope = F.broadcast(scope_table(genes.sparkSession, study))
    return (
        genes.join(scope, "gene_symbol", "left")
        .selectExpr(
            "*",
            "CASE is_in_scope WHEN TRUE THEN 'in_scope' WHEN FALSE THEN 'excluded' "
            "ELSE 'unknown' END AS scope_status",
        )
        .drop("is_in_scope")
    )


def assert_in_scope(gene: str, study: Study) -> None:
    known = {symbol: (in_scope, reason) for symbol, in_scope, reason in study.scope}
    if gene not in known:
        raise OutOfScopeGeneError(
            f"gene {gene!r} is not in the scope definition; in scope: {study.scope_genes}"
        )
    in_scope, reason = known[gene]
    if not in_scope:
        raise OutOfScopeGeneError(f"gene {gene!r} is explicitly excluded: {reason}")


# Rows a table needs before the next stage may start.
MINIMUM_ROWS = {
    "genomes_variants_raw": 1000,
    "pharmgkb_clinical_annotations_raw": 100,
    "cpic_guidelines_raw": 10,
}


def row_gate(tables: Mapping[str, DataFrame], minimum: Mapping[str, int]) -> DataFrame:
    """(table_name, row_count, min_row_count, passed) per table."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(minimum[name]).cast("bigint").alias("min_row_count"),
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts.withColumn("passed", F.col("row_count") >= F.col("min_row_count"))


def require_rows(tables: Mapping[str, DataFrame], minimum: Mapping[str, int]) -> None:
    short = row_gate(tables, minimum).where(~F.col("passed")).collect()
    if short:
        raise DataQualityError(
            "; ".join(f"{r.table_name}: {r.row_count} rows < {r.min_row_count}" for r in short)
        )

