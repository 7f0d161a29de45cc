"""Parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from cohortscope.operators.quality import guarded, validate
from cohortscope.operators.upsert import upsert
from cohortscope.sources.registered import Registered, is_registered, partition_keys, replace_partitions
from cohortscope.sources.tables import partition_columns, stored_files

CODEC = "snappy"


def write_bronze(
    df: DataFrame,
    root: str | Registered,
    ingest_date: date,
    extra_partition: dict[str, object] | None = None,
    order_by: tuple[str, ...] = (),
    rows_per_file: int | None = None,
) -> None:
    """Replace exactly the partitions that are written, if the rows are valid.

    Required columns are checked within the write, which commits nothing when one is
    null; only then does a second pass count the nulls of every column for the message.
    ``extra_partition`` maps further partition columns to a column or a fixed value.
    ``order_by`` sorts within the files (by position, say), which makes their row group
    statistics useful to later region filters. With ``rows_per_file`` each file also covers a
    narrow range of that order: see ``cluster``.
    """
    table = folder_of(root).rsplit("/", 1)[-1]
    partitions = {"ingest_date": F.lit(ingest_date), **(extra_partition or {})}
    rows = guarded(df, table)
    for name, value in partitions.items():
        rows = rows.withColumn(name, F.lit(value) if isinstance(value, str) else value)
    try:
        if rows_per_file:
            rows = cluster(rows, root, [*partitions, *order_by], rows_per_file)
        elif extra_partition:
            # Small partitions are merged and large ones split by adaptive execution.
            rows = rows.hint("rebalance", *extra_partition)
        if order_by:
            rows = rows.sortWithinPartitions(*partitions, *order_by)
        _replace_partitions(rows, root, partitions, rows_per_file)
    except PySparkException:
        validate(df, table)
        raise


def cluster(
    df: DataFrame, root: str | Registered, order_by: Sequence[str], rows_per_file: int
) -> DataFrame:
    """Rows dealt by ranges of the order, of some ``rows_per_file`` each, so that files follow it.

    The ranges come from a sample of the rows, for which Spark computes them twice; they are
    landed first, so sources are read and parsed once, and counted in that pass. Rows that tie in
    the order are told apart by a hash of the whole row: a position with very many rows is split.
    """
    counted = Observation()
    landed = _landed(df.observe(counted, F.count(F.lit(1)).alias("rows")), root)
    ranges = max(1, -(-counted.get["rows"] // rows_per_file))
    return landed.repartitionByRange(ranges, *order_by, F.xxhash64(*landed.columns))


def folder_of(table: str | Registered) -> str:
    return (table.root if isinstance(table, Registered) else table).rstrip("/")


def _replace_partitions(
    df: DataFrame, root: str | Registered, partitions: Iterable[str], rows_per_file: int | None = None
) -> None:
    """``rows_per_file``, where it is given, holds exactly: a range that is larger takes more files."""
    if isinstance(root, Registered):
        replace_partitions(df, root, list(partitions), rows_per_file)
        return
    writer = (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy(*partitions)
    )
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(root)


def upsert_table(
    updates: DataFrame, root: str | Registered, keys: Sequence[str], partition_by: Sequence[str]
) -> None:
    """Replace rows of a partitioned table by business key, or add them; makes a new table.

    The updates are landed once, beside the table. The partitions that occur in them, few by
    design, become a literal filter, so no other partition is read. The merged rows are landed as
    well before they replace the partitions: nothing is read from what is overwritten. A table
    whose files are not partitioned by exactly these columns is refused. Landed rows stay in
    ``<root>.landed/<run>`` until the store's owner removes them.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError(f"partition columns {partition_by} must be part of the key {keys}")
    spark = updates.sparkSession
    landed = _landed(updates, root)
    stored = _stored_layouts(spark, root)
    if stored:
        if stored != {tuple(partition_by)}:
            raise ValueError(f"{root} is partitioned by {sorted(stored)}, not by {partition_by}")
        touched = landed.select(*partition_by).distinct().collect()
        if isinstance(root, Registered):
            current = spark.table(root.name).select(*updates.columns)
        else:
            current = spark.read.schema(updates.schema).parquet(root)
        merged = upsert(in_partitions(current, touched, partition_by), landed, keys)
        landed = _landed(merged, root)
    _replace_partitions(landed.hint("rebalance", *partition_by), root, partition_by)


def _stored_layouts(spark: SparkSession, root: str | Registered) -> set[tuple[str, ...]]:
    """Partition columns of the stored table; none where there is no table."""
    if isinstance(root, Registered):
        return {partition_keys(spark, root)} if is_registered(spark, root) else set()
    try:
        return partition_columns(stored_files(spark, root))
    except FileNotFoundError:
        return set()


def _landed(df: DataFrame, root: str | Registered) -> DataFrame:
    path = f"{folder_of(root)}.landed/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_partitions(df: DataFrame, rows: Sequence, partition_by: Sequence[str]) -> DataFrame:
    """Rows of the partitions that the rows name, by a filter of literals."""

    def is_value(name: str, value: object):
        return F.col(name).isNull() if value is None else F.col(name) == value

    wanted = F.lit(False)
    for row in rows:
        wanted |= reduce(and_, [is_value(n, v) for n, v in zip(partition_by, row)])
    return df.where(wanted)


def write_table(df: DataFrame, root: str | Registered) -> None:
    _replace_table(df.write, root)


def _replace_table(writer: DataFrameWriter, root: str | Registered) -> None:
    writer = writer.mode("overwrite").option("compression", CODEC)
    if isinstance(root, Registered):
        writer.option("path", root.root).format("parquet").saveAsTable(root.name)
    else:
        writer.parquet(root)


def write_variants(df: DataFrame, root: str | Registered, sample_buckets: int | None = None) -> int:
    """Facts by gene and cohort: readers of a few genes or one cohort skip the rest.

    The rebalance hint keeps files few without sending a partition to one task: adaptive
    execution splits a gene and cohort that holds much of the data. Returns the number
    of rows, counted in the same pass.

    ``sample_buckets`` also buckets a registered table by sample, so that aggregates and joins by
    sample need no exchange. A task of the write holds rows of one bucket, or of several small
    ones, and adaptive execution splits a large bucket, which then has several files in a folder.
    Within files rows are sorted by variant, so a filter on variants skips row groups, of a sample
    with very many rows as well.
    """
    keys = ("gene_symbol", "population_code")
    rows = Observation()
    if sample_buckets:
        if not isinstance(root, Registered):
            raise ValueError(f"buckets are kept by the catalog: register {root} to bucket it")
        dealt = df.hint("rebalance", sample_buckets, "sample_id")
    else:
        dealt = df.hint("rebalance", *keys).sortWithinPartitions(*keys, "variant_id")
    counted = dealt.observe(rows, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.partitionBy(*keys)
    if sample_buckets:
        writer = writer.bucketBy(sample_buckets, "sample_id").sortBy("variant_id")
    _replace_table(writer, root)
    return rows.get["rows"]
