"""Duplicate removal with a defined survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order_by``, then by the remaining columns.

    A minimum over the other columns as one struct, rather than a row number: it is
    aggregated before the exchange, so every task sends at most one row per key and a key
    with very many copies stays small, and it sorts by the keys alone.
    """
    columns = df.columns
    order = [c for c in order_by if c not in keys]
    order += [c for c in columns if c not in keys and c not in order]
    if not order:
        return df.distinct()
    first = df.groupBy(*keys).agg(F.expr(f"min(struct({', '.join(order)}))").alias("_first"))
    return first.selectExpr([c if c in keys else f"_first.{c} AS {c}" for c in columns])


#: Characters of hexadecimal that one number holds exactly, and so many numbers.
HEX_DIGITS, NUMBERS = 14, 2


def first_bytes(text: str) -> str:
    """The first bytes of a text as a number in the order of the texts, null before all others."""
    length = HEX_DIGITS * NUMBERS
    digits = f"rpad(hex(substring(CAST({text} AS BINARY), 1, {length // 2})), {length}, '0')"
    high, low = (
        f"CAST(conv(substring({digits}, {1 + i * HEX_DIGITS}, {HEX_DIGITS}), 16, 10) AS DECIMAL(18, 0))"
        for i in range(NUMBERS)
    )
    return f"coalesce(CAST({high} * {16**HEX_DIGITS} + {low} AS DECIMAL(38, 0)), CAST(-1 AS DECIMAL(38, 0)))"


def may_be_first(df: DataFrame, keys: Sequence[str], start: str) -> DataFrame:
    """The rows with the least ``start`` of their key: those that ``keep_first`` may choose, and some more.

    The minimum of a struct or a text sorts all rows of a task, as they are. The minimum of a
    number does not: a task holds one number per key. So, where a key has many copies of wide rows,
    this goes before ``keep_first``, with the ``first_bytes`` of its first column. Texts
    that share these bytes all stay, so no row is lost that might be first.
    """
    named = [F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]
    least = df.groupBy(*named).agg(F.min(start).alias("_least"))
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    return df.join(least, [*same, F.col(start) == F.col("_least")], "left_semi")


def lookup_side(df: DataFrame, key: str) -> DataFrame:
    """One row per text key, made ready to be the small side of a join.

    The rows come out of the deduplication partitioned by the key. Were the join to use
    that partitioning, only its large side would be shuffled for it, and adaptive
    execution splits a hot key only where both sides are. Passing the key through an
    expression asks for an exchange of the (small) side as well.
    """
    rest = [c for c in df.columns if c != key]
    return keep_first(df, [key]).selectExpr(f"concat({key}, '') AS {key}", *rest)
