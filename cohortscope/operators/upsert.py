"""Replacing rows of a stored table by business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(current: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updated rows, and the current rows whose key has no update; a null equals a null."""
    own = updates.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
    return current.join(own, same, "left_anti").unionByName(updates)
