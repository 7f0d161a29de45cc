"""Gene assignment by bins against brute force."""

from __future__ import annotations

import random
import re

import pytest
from checks import rows

from cohortscope.operators import intervals
from cohortscope.operators.intervals import assign_genes_by_bins, cut_regions, filed_pieces

REGION = "gene_symbol string, chromosome string, region_start long, region_end long, listed long"


def made(n, seed=1, longest=7, room=5_000_000):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        start = pick.randrange(room)
        out.append((f"G{i}", f"chr{pick.randrange(3)}", start, start + int(10 ** pick.uniform(0, longest)), i))
    return out


def brute(sites, regions):
    found = []
    for chromosome, position in sites:
        hits = [r for r in regions if r[1] == chromosome and position is not None and r[2] <= position <= r[3]]
        found.append((chromosome, position, max(hits, key=lambda r: r[4])[0] if hits else None))
    return sorted(found, key=repr)


def edges(regions, pick):
    near = [(r[1], r[pick.choice([2, 3])] + pick.choice([-1, 0, 1])) for r in regions]
    return near + [(f"chr{pick.randrange(4)}", pick.randrange(6_000_000)) for _ in range(500)] + [
        ("chr1", None), (None, 5), ("chr0", 0), ("chr1", 1 << 20), ("chr1", (1 << 20) - 1),
    ]


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_overlapping_regions(spark, monkeypatch, broadcast):
    monkeypatch.setattr(intervals, "BROADCAST_PIECES", broadcast)
    regions = made(300)
    sites = edges(regions, random.Random(2))
    table = spark.createDataFrame(regions + [("bad", "chr1", 9, 3, 999), (None, None, 1, 2, 998)], REGION)
    df = spark.createDataFrame(sites, "chromosome string, position long")
    expected = brute(sites, regions)
    assert sorted((tuple(r) for r in assign_genes_by_bins(df, table).collect()), key=repr) == expected
    kept = assign_genes_by_bins(df, table, keep=True)
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == [r for r in expected if r[2] is not None]


def test_pieces_are_disjoint_and_few_share_a_bin(spark):
    regions = spark.createDataFrame(made(20_000, longest=5, room=100_000_000), REGION)
    pieces = cut_regions(regions).cache()
    following = "lead(piece_start) OVER (PARTITION BY chromosome ORDER BY piece_start)"
    assert pieces.selectExpr(f"{following} <= piece_end AS clash").where("clash").isEmpty()
    filed = filed_pieces(pieces)
    assert filed.groupBy("chromosome", "shift", "bin").count().agg({"count": "max"}).first()[0] < 70
    assert filed.count() < 5 * pieces.count()
    pieces.unpersist()


def test_regions_are_not_compared_with_the_pieces_they_cover(spark):
    nested = [(f"G{i}", "chr1", i, 900_000 - i, i * 7 % 4001) for i in range(2000)]
    pieces = cut_regions(spark.createDataFrame(nested, REGION))
    found = [(r.piece_start, r.piece_end, r.gene_symbol) for r in pieces.collect()]
    assert len(found) == 2 * 2000 - 1
    for start, end, gene in found[::97]:
        assert [r[2] for r in brute([("chr1", start), ("chr1", end)], nested)] == [gene, gene]
    plan = spark._jvm.PythonSQLUtils.explainString(pieces._jdf.queryExecution(), "formatted")
    conditions = re.findall("Join condition: (.*)", plan)
    assert conditions and set(conditions) == {"None"} and "BroadcastHashJoin" not in plan


def test_equality_joins_only(spark):
    table = spark.createDataFrame(made(50), REGION)
    df = spark.createDataFrame([("chr1", 5, "x")], "chromosome string, position long, gene string")
    plan = assign_genes_by_bins(df, table)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "BroadcastHashJoin" in plan


def test_no_regions(spark):
    df = spark.createDataFrame([("chr1", 5)], "chromosome string, position long")
    none = spark.createDataFrame([], REGION)
    assert rows(assign_genes_by_bins(df, none)) == [("chr1", 5, None)]
    assert rows(assign_genes_by_bins(df, none, keep=True)) == []
