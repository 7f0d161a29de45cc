"""Positions against very many regions: hierarchical bins as keys of equality joins.

Regions are cut into disjoint pieces, the last listed region winning, within coarse bins, so
the cutting is spread over tasks. Each piece is then filed in the bins of the level that fits its
length. A position has one bin of each level; one equality join per level finds its piece, and as
the pieces are disjoint, one of them at most. Rows are never multiplied or grouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Positions of a bin, as powers of two: of the cutting, and of the levels pieces are filed in.
CUT_SHIFT, SHIFTS = 20, (8, 11, 14, 17, 20)
#: A block is as long as two to this power of the next smaller ones.
BLOCK_BITS = 2
#: Bins that a piece may reach over before it goes a level up.
REACH = 4
#: Filed pieces up to which a level is broadcast; beyond, both sides are sorted.
BROADCAST_PIECES = 200_000


def cut_regions(regions: DataFrame) -> DataFrame:
    """(chromosome, piece_start, piece_end, gene_symbol): disjoint pieces of overlapping regions.

    ``regions`` has gene_symbol, chromosome, region_start, region_end (both ends belong to it) and
    ``listed``, its place in the list: where regions overlap, the last listed one holds. Regions
    with a null or with an end before their start are left out.

    A region is written as the largest aligned blocks that fill it, some for each size of block, and a
    block keeps its last place in the list. All regions over a piece have a block at the piece's start,
    so a piece looks up one block of each size: no region is compared with the pieces it covers.
    """
    cut = regions.where("region_start <= region_end AND chromosome IS NOT NULL").selectExpr(
        "chromosome", "gene_symbol", "listed", "CAST(region_start AS BIGINT) AS region_start",
        "CAST(region_end AS BIGINT) AS region_end",
        f"explode(sequence(shiftright(region_start, {CUT_SHIFT}), shiftright(region_end, {CUT_SHIFT}))) AS bin",
    ).selectExpr(
        "chromosome", "CAST(bin AS BIGINT) AS bin", "gene_symbol", "listed",
        f"greatest(region_start, shiftleft(CAST(bin AS BIGINT), {CUT_SHIFT})) AS first",
        f"least(region_end, shiftleft(CAST(bin AS BIGINT) + 1, {CUT_SHIFT}) - 1) AS last",
    )
    edges = cut.selectExpr("chromosome", "bin", "explode(array(first, last + 1)) AS piece_start").distinct()
    spans = edges.selectExpr(
        "*", "lead(piece_start) OVER (PARTITION BY chromosome, bin ORDER BY piece_start) - 1 AS piece_end"
    ).where("piece_end IS NOT NULL")
    sizes = f"explode(sequence(0, {CUT_SHIFT}, {BLOCK_BITS})) AS size"
    looked_up = spans.selectExpr("*", sizes).withColumn("block", F.expr("shiftright(piece_start, size)"))
    # Explode multiplies rows unseen by size estimates, which would have the large sides broadcast.
    blocks = _blocks(cut.selectExpr("chromosome", "listed", "first", "last", sizes)).hint("merge")
    covered = (
        looked_up.join(blocks, ["chromosome", "size", "block"])
        .groupBy("chromosome", "bin", "piece_start", "piece_end")
        .agg(F.max("listed").alias("listed"))
    )
    genes = cut.groupBy("chromosome", "bin", "listed").agg(F.max("gene_symbol").alias("gene_symbol"))
    return covered.join(genes.hint("merge"), ["chromosome", "bin", "listed"], "left").select(
        "chromosome", "piece_start", "piece_end", "gene_symbol"
    )


def _blocks(cut: DataFrame) -> DataFrame:
    """(chromosome, size, block, listed): the blocks of each size that lie inside a region, but in no
    larger block inside it, with the last place of their regions in the list."""
    wider = f"size + {BLOCK_BITS}"
    whole = {
        "low": "shiftright(first + shiftleft(1L, size) - 1, size)",
        "high": "shiftright(last + 1, size)",
        "wide_low": f"shiftright(first + shiftleft(1L, {wider}) - 1, {wider})",
        "wide_high": f"shiftright(last + 1, {wider})",
    }
    sides = cut.selectExpr("*", *[f"{value} AS {name}" for name, value in whole.items()]).selectExpr(
        "chromosome", "listed", "size", "low", "high",
        f"IF(wide_low < wide_high, shiftleft(wide_low, {BLOCK_BITS}), high) AS left_end",
        f"IF(wide_low < wide_high, shiftleft(wide_high, {BLOCK_BITS}), high) AS right_start",
    ).where("low < high")
    listed = ", ".join(
        f"IF({a} < {b}, sequence({a}, {b} - 1), CAST(array() AS ARRAY<BIGINT>))"
        for a, b in (("low", "left_end"), ("right_start", "high"))
    )
    filled = sides.selectExpr("chromosome", "listed", "size", f"explode(concat({listed})) AS block")
    return filled.groupBy("chromosome", "size", "block").agg(F.max("listed").alias("listed"))


def filed_pieces(pieces: DataFrame) -> DataFrame:
    """Pieces with the shift of their level, one row for each bin of that level they reach into."""
    level = " ".join(
        f"WHEN shiftright(piece_end, {s}) - shiftright(piece_start, {s}) < {REACH} THEN {s}" for s in SHIFTS
    )
    return pieces.selectExpr("*", f"CASE {level} ELSE {SHIFTS[-1]} END AS shift").selectExpr(
        "*", "explode(sequence(shiftright(piece_start, shift), shiftright(piece_end, shift))) AS bin"
    )


def assign_genes_by_bins(df: DataFrame, regions: DataFrame, *, keep: bool = False) -> DataFrame:
    """Adds ``gene_symbol`` by (chromosome, position), null outside all regions.

    For thousands of regions and more, as ``assign_genes`` is for those of a study. ``regions`` as in
    ``cut_regions``. With ``keep`` rows outside all regions are dropped. Only the levels that pieces
    use are joined; a level's pieces are broadcast up to ``BROADCAST_PIECES`` rows.
    """
    filed = filed_pieces(cut_regions(regions))
    sizes = {r["shift"]: r["count"] for r in filed.groupBy("shift").count().collect()}
    genes, columns = [], df.columns
    found = df
    for shift in sorted(sizes):
        gene = f"_gene_{shift}"
        level = filed.where(F.col("shift") == shift).selectExpr(
            "chromosome AS _chromosome", "bin AS _bin", "piece_start AS _first", "piece_end AS _last",
            f"struct(gene_symbol) AS {gene}",
        )
        level = level.hint("broadcast" if sizes[shift] <= BROADCAST_PIECES else "merge")
        hit = F.expr(
            f"chromosome = _chromosome AND shiftright(CAST(position AS BIGINT), {shift}) = _bin "
            "AND position BETWEEN _first AND _last"
        )
        found = found.join(level, hit, "left").select(*columns, *genes, gene)
        genes.append(gene)
    which = f"coalesce({', '.join(genes)})" if genes else "CAST(NULL AS STRUCT<gene_symbol: STRING>)"
    found = found.withColumn("_found", F.expr(which))
    if keep:
        found = found.where("_found IS NOT NULL")
    return found.select(*columns, F.col("_found.gene_symbol").alias("gene_symbol"))
