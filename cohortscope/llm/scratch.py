"""Tables between the jobs of one operator call.

They lie in the folder that the session names in ``spark.checkpoint.dir``, which all executors
share, so a lost executor costs tasks and no data. One call uses one new subfolder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names; an error where it names none."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return folder.rstrip("/")


class Scratch:
    """Stored tables of one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Writes the rows and reads them back: a plan without lineage."""
        self.count += 1
        path = f"{self.folder}/{self.count:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
