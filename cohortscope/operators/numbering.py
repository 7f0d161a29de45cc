"""Row numbers in one order over all rows, without a task that sees them all."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Positions of equal rows that one row of the last step but one stands for.
BLOCK = 65_536


def number_rows(
    df: DataFrame,
    order_by: Sequence[Column],
    store: Callable[[DataFrame], DataFrame],
    name: str = "row_position",
    ranges: int | None = None,
) -> DataFrame:
    """Adds the position, from 1, of each row in the order; rows that tie are ordered by all columns.

    Rows are dealt by ranges of the order and landed by ``store`` (a table written and read
    again) with the number of their range, so the ranges are drawn once. The rows before a range
    are the sum of the counts of the ranges ahead of it, one row for each range; within a range a
    window numbers its own rows. Equal rows are one row with a count until the end, so neither a
    score that many rows share nor a row that comes very often makes a large range.
    ``ranges`` defaults to the session's shuffle partitions. Columns must be comparable (no maps).
    """
    columns = df.columns
    ties = [F.asc(f"`{c}`") for c in columns]
    counted = df.groupBy(*[f"`{c}`" for c in columns]).agg(F.count(F.lit(1)).alias("_copies"))
    dealt = counted.repartitionByRange(*([ranges] if ranges else []), *order_by, *ties)
    landed = store(dealt.withColumn("_range", F.spark_partition_id()))
    sizes = landed.groupBy("_range").agg(F.sum("_copies").alias("_size"))
    before = sizes.selectExpr("_range", "sum(_size) OVER (ORDER BY _range) - _size AS _before")
    # One row for each range, and there are no more of them than shuffle partitions.
    offset = landed.join(F.broadcast(before), "_range")
    own = F.sum("_copies").over(_window(order_by, ties))
    first = offset.withColumn("_first", F.col("_before") + own - F.col("_copies") + 1)
    last = f"least(_first + (_block + 1) * {BLOCK}, _first + _copies) - 1"
    kept = [f"`{c}`" for c in columns]
    return first.selectExpr(
        *kept, "_first", "_copies", f"explode(sequence(0L, (_copies - 1) div {BLOCK})) AS _block"
    ).selectExpr(*kept, f"explode(sequence(_first + _block * {BLOCK}, {last})) AS `{name}`")


def _window(order_by: Sequence[Column], ties: Sequence[Column]) -> WindowSpec:
    ordered = Window.partitionBy("_range").orderBy(*order_by, *ties)
    return ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
