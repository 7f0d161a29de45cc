"""Mixing and decontamination."""

from __future__ import annotations

import brute
import pytest
from samples import awkward_rows, prose

from cohortscope.llm.decontam import drop_contaminated, find_contaminated
from cohortscope.llm.mixing import mix_sources


def test_targets(awkward, nothing):
    targets = brute.mix([(d, s, t) for d, t, s in awkward_rows()])
    source = {(d, len(brute.words(t))): s for d, t, s in awkward_rows()}
    found = mix_sources(awkward).collect()
    assert len(found) == len(awkward_rows())
    for r in found:
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        size, target = targets[source[r.doc_id, r.size]]
        assert r.source_size == size and r.target == pytest.approx(target)
    assert sorted(map(repr, found)) == sorted(map(repr, mix_sources(awkward.repartition(2)).collect()))
    assert mix_sources(nothing).count() == 0


@pytest.mark.parametrize(
    "sizes",
    [{"a": 50, "b": 50}, {"a": 10, "b": 400, "c": 300, "d": 200, None: 5, "": 100}, {"a": 0, "b": 7}, {"a": 0}],
)
def test_targets_where_several_sources_stay_below_their_cap(spark, sizes):
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate(sizes.items())]
    expected = brute.mix(rows)
    found = mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    by_id = {i: expected[s] for i, s, _ in rows}
    assert {r.doc_id: (r.source_size, r.target) for r in found} == {
        i: (size, pytest.approx(target)) for i, (size, target) in by_id.items()
    }


def test_taken_words_come_near_the_targets(spark):
    rows = spark.range(20_000).selectExpr(
        "id AS doc_id", "repeat('w ', CAST(1 + id % 17 AS INT)) AS text",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 7) END AS source",
    )
    mixed = mix_sources(rows).join(rows.select("doc_id", "source"), "doc_id")
    for r in mixed.groupBy("source", "target").agg({"taken": "sum"}).collect():
        assert abs(r["sum(taken)"] - r.target) <= 17


ITEM = "Maria bought 12 kg of red apples and 3 bags of flour, then Maria sold 12 apples to Tom near the old river."


def benchmark(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def found(spark, texts, *items, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = find_contaminated(docs, benchmark(spark, *items), **options).collect()
    return sorted((r.doc_id, r.item_id) for r in rows)


def test_copies_and_exchanged_names_and_numbers(spark):
    changed = ITEM.replace("Maria", "Olga").replace("12", "7").replace("Tom", "Ivan").replace("kg", "lb")
    mixed_up = ITEM.replace("then Maria", "then Peter").replace("sold 12", "sold 99").replace("3", "12")
    texts = [
        prose(1, 30) + " " + ITEM + " " + prose(2, 30),
        prose(3, 50) + "\n" + changed.lower().replace("olga", "Olga").replace("ivan", "Ivan"),
        prose(4, 200),
        ITEM[:40],
        mixed_up,
        None,
        "",
    ]
    assert found(spark, texts, ITEM, None, "", "too short") == [(0, 0), (1, 0)]
    assert found(spark, texts, ITEM, agree=0.1) == [(0, 0), (1, 0), (4, 0)]


def test_short_items_and_decimals(spark):
    item = "add 3.5 liters of warm water slowly"
    assert found(spark, ["please add 12 liters of warm water slowly", "add liters of water"], item) == [(0, 0)]


def test_capitals_make_no_difference(spark):
    lost = "IN WHICH YEAR DID THE GREAT RIVER FLOOD THE 12 KG STONE BRIDGE OF THE OLD TOWN"
    texts = [
        prose(1, 30) + " " + ITEM.upper() + " " + prose(2, 30),
        prose(3, 30) + " " + ITEM.upper().replace("12", "40"),
        prose(4, 30) + " " + lost + " " + prose(5, 30),
        prose(6, 30) + " " + lost.title(),
        prose(7, 30) + " " + lost.lower().replace("12", "99"),
        "rows 10 20 30 40 50 60 70 80 90 end",
        "rows 11 21 31 41 51 61 71 81 91 end",
    ]
    numbers = "10 20 30 40 50 60 70 80 90"
    assert found(spark, texts, ITEM, lost, numbers) == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 1), (5, 2)]


def test_exchanged_words_of_another_number(spark):
    short = "the old farmer Tom gave 5 kg of ripe pears to the shop"
    between = prose(7, 14).lower() + " with Tom " + prose(8, 14).lower()
    texts = [
        prose(1, 30) + " " + short.replace("Tom", "Mary Ann"),
        prose(2, 30) + " " + short.replace("5 kg", "7kg") + " " + prose(3, 30),
        prose(4, 30) + " " + short.upper().replace("5 KG", "7KG"),
        prose(5, 30) + " " + between.replace("Tom", "Vasco da Gama") + " " + prose(6, 30),
    ]
    assert found(spark, texts, short, between) == [(0, 0), (1, 0), (2, 0), (3, 1)]


def test_two_words_exchanged_for_one(spark):
    item = "in the garden Tom has 3 apples and after the walk Ann has 4 apples in a large basket"
    same = item.replace("3", "5").replace("4", "5")
    clash = item.replace("Ann has 4", "Tom has 3")
    texts = [same, same.replace("has", "had"), item]
    assert found(spark, texts, item) == [(0, 0), (2, 0)]
    assert found(spark, [item.replace("Ann", "Eve").replace("4", "8")], clash) == []


def test_awkward_documents(spark, awkward, nothing):
    passage = prose(4, 40)
    items = benchmark(spark, passage, None)
    rows = find_contaminated(awkward, items).collect()
    assert sorted(r.doc_id for r in rows) == [5, 6, 7, 16]
    kept = drop_contaminated(awkward, items)
    assert kept.columns == awkward.columns and kept.count() == len(awkward_rows()) - 4
    assert find_contaminated(nothing, items).count() == 0
    assert find_contaminated(awkward, items.limit(0)).count() == 0
    assert drop_contaminated(awkward, items.limit(0)).count() == len(awkward_rows())


def test_windows_joined_without_broadcast(spark, awkward, monkeypatch):
    from cohortscope.llm import decontam

    items = benchmark(spark, prose(4, 40))
    expected = sorted(map(repr, find_contaminated(awkward, items).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert sorted(map(repr, find_contaminated(awkward, items).collect())) == expected
