"""Variant call files: text lines and the sample columns of their headers."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscope.operators.dimensions import local_table
from cohortscope.operators.melt import (
    FIXED_FIELDS,
    assemble_variants,
    parse_records,
)
from cohortscope.sources.block_gzip import FILE, PACKED, head_lines, listed, packed_lines
from cohortscope.study import Study

logger = logging.getLogger(__name__)

HEADER_MARK = "#CHROM"

@dataclass
class Headers:
    """Distinct header lines, and which of them each file has."""

    lines: dict[str, int] = field(default_factory=dict)
    files: dict[str, int] = field(default_factory=dict)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, value) of plain files, which Spark splits, and of compressed ones, split by blocks."""
    plain = spark.read.text(path).selectExpr(f"{FILE} AS file", "value")
    if listed(spark, path).where(f"file RLIKE '{PACKED}'").isEmpty():
        return plain
    # The condition on the file keeps the others from being opened.
    plain = spark.read.text(path).where(f"NOT _metadata.file_path RLIKE '{PACKED}'")
    plain = plain.selectExpr(f"{FILE} AS file", "value")
    return plain.unionByName(packed_lines(spark, path))


def read_headers(spark: SparkSession, path: str | list[str]) -> Headers:
    """Header line of every file, each different line kept once.

    One job over the first lines of all files, however many there are, and a group per
    different header. The driver gets the header text and the list of files, which the
    reader's own file index holds as well.
    """
    found = (
        head_lines(spark, path).where(F.col("value").startswith(HEADER_MARK))
        .groupBy("value")
        .agg(F.sort_array(F.collect_set("file")).alias("files"))
        .orderBy("value")
        .collect()
    )
    headers = Headers()
    for row in found:
        number = headers.lines.setdefault(row["value"], len(headers.lines))
        headers.files.update((file, number) for file in row["files"])
    known = {_bare(file) for file in headers.files}
    for file in spark.read.text(path).inputFiles():
        if _bare(file) not in known:
            raise RuntimeError(f"{file} has no {HEADER_MARK} header line")
    return headers


def _bare(uri: str) -> str:
    """A file's URI with one slash after its scheme, as both listings name it."""
    return re.sub(r"^(\w+):/+", r"\1:/", uri)


def lines_with_header(spark: SparkSession, path: str | list[str], headers: Headers) -> DataFrame:
    """(header, value): each line with the number of its file's header.

    The table of files is broadcast: it is no larger than the reader's file index.
    """
    lines = read_lines(spark, path)
    if len(headers.lines) == 1:
        return lines.selectExpr("0 AS header", "value")
    files = local_table(
        spark, list(headers.files.items()), [("file", pa.string()), ("header", pa.int32())]
    )
    return lines.join(F.broadcast(files), "file").select("header", "value")


def sample_columns(spark: SparkSession, headers: Headers, samples: DataFrame) -> DataFrame:
    """(header, column_index, sample_id) of the wanted samples."""
    table = local_table(
        spark, list(headers.lines.items()), [("line", pa.string()), ("header", pa.int32())]
    )
    columns = (
        table.selectExpr("header", "posexplode(split(line, '\\t')) AS (field, sample_id)")
        .selectExpr("header", f"field - {FIXED_FIELDS} AS column_index", "sample_id")
        .where("column_index >= 0")
    )
    return columns.join(samples.select("sample_id"), "sample_id", "left_semi")


def check_samples(spark: SparkSession, headers: Headers, samples: DataFrame) -> None:
    """Warn about panel samples without a column; raise if a header has none of them."""
    counts = sample_columns(spark, headers, samples).groupBy("header").count()
    matched = {r["header"]: r["count"] for r in counts.collect()}
    expected = samples.select("sample_id").distinct().count()
    for file, header in headers.files.items():
        if header not in matched:
            raise RuntimeError(f"no target samples found in {file}: panel and calls do not match")
        if matched[header] < expected:
            logger.warning("%s lacks %d target samples", file, expected - matched[header])


def read_genotypes(
    spark: SparkSession, path: str | list[str], samples: DataFrame, study: Study
) -> DataFrame:
    """Calls of the study's regions and samples, one row per variant and sample."""
    headers = read_headers(spark, path)
    check_samples(spark, headers, samples)
    records = parse_records(lines_with_header(spark, path, headers), study)
    return assemble_variants(records, sample_columns(spark, headers, samples))
