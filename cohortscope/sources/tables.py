"""Stored tables: latest or given bronze partition, whole silver and gold tables.

A table is the path of its folder, or ``Registered`` in the catalog; only the former is listed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscope.sources.registered import Registered, is_registered, latest_value, partitions, read_registered

DATE_DIRECTORY = "ingest_date="


def stored_files(spark: SparkSession, root: str) -> list[str]:
    """Parquet files under a folder: they are listed, none is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    try:
        return files.load(root).inputFiles()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"table not found: {root}; run the earlier stage first") from None
        raise


def partition_columns(files: Sequence[str]) -> set[tuple[str, ...]]:
    """The partition columns above each file, as its folders name them."""
    found = set()
    for file in files:
        folders = file.split("/")[:-1]
        named = [f.partition("=")[0] if "=" in f else None for f in folders]
        last = max((i for i, n in enumerate(named) if n is None), default=-1)
        found.add(tuple(named[last + 1 :]))
    return found


def latest_date(spark: SparkSession, table: str | Registered) -> str:
    """Greatest ingest date among the catalog's partitions, or among the stored files."""
    if isinstance(table, Registered):
        if not is_registered(spark, table):
            raise FileNotFoundError(f"table not found: {table}; run the earlier stage first")
        latest = latest_value(spark, table, "ingest_date")
        if latest is None:
            raise FileNotFoundError(f"no ingest_date partitions of {table}")
        return latest
    pattern = re.compile(rf"/{DATE_DIRECTORY}([^/]+)/")
    dates = [found[1] for f in stored_files(spark, table) if (found := pattern.search(f))]
    if not dates:
        raise FileNotFoundError(
            f"no {DATE_DIRECTORY} partitions in {table}: no Parquet files found in any"
        )
    return max(dates)


def read_latest(spark: SparkSession, table: str | Registered) -> DataFrame:
    return read_date(spark, table, latest_date(spark, table))


def read_date(spark: SparkSession, table: str | Registered, day: date | str) -> DataFrame:
    """One ingest date, with the partition columns; other dates are not even listed."""
    if isinstance(table, Registered):
        found = read_registered(spark, table, F.col("ingest_date") == F.lit(str(day)).cast("date"))
        if partitions(spark, table, ingest_date=day).isEmpty():
            raise FileNotFoundError(f"no partition {DATE_DIRECTORY}{day} of {table}")
        return found
    return spark.read.option("basePath", table).parquet(f"{table}/{DATE_DIRECTORY}{day}")


def read_table(spark: SparkSession, table: str | Registered) -> DataFrame:
    if isinstance(table, Registered):
        return read_registered(spark, table)
    if not stored_files(spark, table):
        raise FileNotFoundError(f"no Parquet files found in {table}")
    return spark.read.parquet(table)
