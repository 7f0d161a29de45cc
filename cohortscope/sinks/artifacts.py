"""JSON artifacts and text documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cohortscope.operators.exports import artifact


def write_json(df: DataFrame, path: str) -> int:
    """JSON lines with nulls spelled out; the row count comes from the same pass."""
    rows = Observation()
    (
        df.observe(rows, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .option("dateFormat", "yyyy-MM-dd")
        .json(path)
    )
    return rows.get["rows"]


def export_artifact(df: DataFrame, name: str, root: str) -> int:
    return write_json(artifact(df, name), f"{root}/{name}")


def write_documents(documents: DataFrame, path: str) -> None:
    """(path, document) rows; a file store can lay them out as one file per path."""
    documents.write.mode("overwrite").parquet(path)
