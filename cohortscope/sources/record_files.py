"""JSON records: values as their text, and records of another shape by name.

A line holds one record or an array of them, as a page of a service does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortscope.functions import literal
from cohortscope.schemas import fields_of

#: Kind of a variant's type where the declared type is nested.
SHAPES = {"map": "OBJECT", "array": "ARRAY"}


def _kind(variant: str) -> str:
    """First word of the variant's type: OBJECT, ARRAY, STRING, BIGINT, ...; VOID for null."""
    return f"regexp_extract(coalesce(schema_of_variant({variant}), 'VOID'), '^[A-Z]+', 0)"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) the lines of the files that are not blank."""
    lines = spark.read.text(path).selectExpr("_metadata.file_path AS file", "value AS line")
    return lines.where("trim(line) <> ''")


def split_records(lines: DataFrame, ddl: str) -> DataFrame:
    """Adds to each line's columns, once per record: the declared columns, ``problem`` and ``record``.

    Scalars become text, within maps and arrays as well: fractions in their shortest form (``1.0``
    stays, ``1.50`` is ``1.5``), whole numbers digit by digit. Values nested deeper become JSON text.
    ``problem`` is null for a record that fits. It names a line that is no JSON (or has a key twice,
    or exceeds what a variant holds), a record that is no object, the other records of its array,
    which can't be read beside it, and a column in which a list or a map was declared and something
    else came; a column that is absent or null is null. ``record`` is the JSON text of the record,
    or the line where it can't be read.
    """
    fields = fields_of(ddl)
    kept = lines.columns
    struct = ", ".join(f"`{name}`: {kind}" for name, kind in fields)
    split = (
        lines.selectExpr("*", "try_parse_json(line) AS _json")
        .selectExpr(
            "*",
            f"from_json(line, 'array<struct<{struct}>>') AS _values",
            "coalesce(try_variant_get(_json, '$', 'array<variant>'), array(_json)) AS _records",
        )
        .selectExpr(*[f"`{c}`" for c in kept], "_values", "posexplode(_records) AS (_place, _record)")
        .selectExpr("*", "get(_values, _place) AS _value")
    )
    wrong = " ".join(
        f"WHEN {kind} NOT IN ('VOID', '{shape}') "
        f"THEN concat({literal(f'{name} is no {declared}: ')}, {kind})"
        for name, declared in fields
        for shape in [SHAPES.get(declared.partition("<")[0])]
        if shape
        for kind in [_kind(f"try_variant_get(_record, '$.{name}', 'variant')")]
    )
    problem = (
        "CASE WHEN _record IS NULL THEN 'no JSON' "
        f"WHEN {_kind('_record')} <> 'OBJECT' THEN concat('no object: ', {_kind('_record')}) "
        f"{wrong} WHEN _value IS NULL THEN 'unreadable' END"
    )
    return split.selectExpr(
        *[f"`{c}`" for c in kept],
        *[f"_value.`{name}`" for name, _ in fields],
        f"{problem} AS problem",
        "coalesce(to_json(_record), line) AS record",
    )


def read_records(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The declared columns of all records; a record of another shape fails the read and is named."""
    found = split_records(read_lines(spark, path), ddl)
    complaint = "concat(file, ': ', problem, ' in ', left(record, 200))"
    # A filter, as a column with the check would be pruned where nobody selects it.
    checked = found.where(f"CASE WHEN problem IS NULL THEN TRUE ELSE raise_error({complaint}) END")
    return checked.select([name for name, _ in fields_of(ddl)])


def refused_records(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """(file, problem, record) what ``read_records`` would fail on."""
    found = split_records(read_lines(spark, path), ddl)
    return found.where("problem IS NOT NULL").select("file", "problem", "record")
