"""Tables that the session's catalog knows: partitions are looked up there, no folder is listed.

With a shared metastore the registration lasts; a session of its own catalog adopts the folders.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Registered:
    """Name of a table in the catalog, and the folder of its files."""

    name: str
    root: str

    def __str__(self) -> str:
        return self.name

    @property
    def quoted(self) -> str:
        return ".".join(f"`{part}`" for part in self.name.split("."))


def is_registered(spark: SparkSession, table: Registered) -> bool:
    return spark.catalog.tableExists(table.name)


def register(spark: SparkSession, table: Registered, schema: StructType, partition_by: Sequence[str]) -> None:
    """Makes the table, without partitions, where the catalog has none of that name.

    Writes replace the partitions that they write and no others.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(f"`{c}`" for c in partition_by)
    root = table.root.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table.quoted} ({columns}) USING parquet "
        f"OPTIONS (partitionOverwriteMode 'dynamic', compression 'snappy') "
        f"PARTITIONED BY ({keys}) LOCATION '{root}'"
    )


def adopt(spark: SparkSession, table: Registered, schema: StructType, partition_by: Sequence[str]) -> None:
    """Registers a folder that was written by path; the only listing of the whole folder."""
    register(spark, table, schema, partition_by)
    spark.sql(f"MSCK REPAIR TABLE {table.quoted}")


def partition_keys(spark: SparkSession, table: Registered) -> tuple[str, ...]:
    """Partition columns, in the order of the folders."""
    return tuple(c.name for c in spark.catalog.listColumns(table.name) if c.isPartition)


def partitions(spark: SparkSession, table: Registered, **values: object) -> DataFrame:
    """(partition) the registered partitions, ``key=value/…``, that have the given leading values."""
    spec = ", ".join(f"`{key}` = '{value}'" for key, value in values.items())
    return spark.sql(f"SHOW PARTITIONS {table.quoted}" + f" PARTITION ({spec})" * bool(values))


def latest_value(spark: SparkSession, table: Registered, key: str) -> str | None:
    """Greatest registered value of a partition column, as text; null where there is none."""
    value = F.regexp_extract("partition", f"(?:^|/){key}=([^/]+)", 1)
    return partitions(spark, table).agg(F.max(value)).first()[0]


def read_registered(spark: SparkSession, table: Registered, where: Column | None = None) -> DataFrame:
    """Rows of the table; with a condition on partition columns only their folders are listed."""
    if not is_registered(spark, table):
        raise FileNotFoundError(f"table not found: {table}; run the earlier stage first")
    found = spark.table(table.name)
    return found if where is None else found.where(where)


def replace_partitions(
    df: DataFrame, table: Registered, partition_by: Sequence[str], rows_per_file: int | None = None
) -> None:
    """Replaces the partitions that occur in the rows; the catalog learns of new ones by the write."""
    spark = df.sparkSession
    partition_by = list(partition_by)
    rest = [c for c in df.columns if c not in partition_by]
    ordered = df.select(*rest, *partition_by)
    register(spark, table, ordered.schema, partition_by)
    stored = spark.table(table.name).columns
    if sorted(stored) != sorted(ordered.columns):
        raise ValueError(f"{table} has the columns {stored}, the rows have {ordered.columns}")
    with _setting(spark, "spark.sql.files.maxRecordsPerFile", rows_per_file):
        ordered.select(*stored).write.insertInto(table.name, overwrite=True)


@contextmanager
def _setting(spark: SparkSession, name: str, value: int | None) -> Iterator[None]:
    """A setting for one write: inserts into a table take no options of the writer."""
    if value is None:
        yield
        return
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)
