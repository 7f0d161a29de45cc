from __future__ import annotations

import re

import pytest

from cohortscope import domain
from cohortscope.functions import literal, lookup
from cohortscope.functions.text import (
    WHITESPACE,
    cross_reference_ids,
    listed_names,
    name_key,
    recommendation_flags,
    summary,
    whole_number,
)


def flags(spark, pairs):
    change, alternative = recommendation_flags("text", "strength")
    df = spark.createDataFrame(pairs, "i int, text string, strength string")
    found = df.selectExpr("i", f"{change} AS c", f"{alternative} AS a").orderBy("i").collect()
    return [(r.c, r.a) for r in found]


CASES = [
    ("Avoid use in poor metabolizers.", "Strong", (False, True)),
    ("Reduce dose by 50% for intermediate metabolizers.", "Strong", (True, False)),
    ("Reduce dose or use alternative drug.", "No recommendation", (False, False)),
    ("Reduce dose.", "", (False, False)),
    ("Reduce dose.", "  ", (False, False)),
    ("Reduce dose.", None, (False, False)),
    ("Reduce dose.", "\tNO RECOMMENDATION\n", (False, False)),
    ("Standard dosing is appropriate.", "Strong", (False, False)),
    ("If poor: reduce dose or consider alternative therapy.", "Strong", (True, True)),
    ("AVOID USE IN POOR METABOLIZERS.", "Strong", (False, True)),
    ("Titrate carefully based on response.", "Moderate", (True, False)),
    ("No reason to avoid this.", "Strong", (False, True)),
    ("Substitute another statin.", "Strong", (False, False)),
    ("Use 50 % of the dose", "anything", (True, False)),
    ("select an other / use another agent", "Strong", (False, True)),
    (None, "Strong", (False, False)),
    ("préavoid", "Strong", (False, False)),
    ("éreduce or avoidé", "Strong", (False, False)),
]


def test_recommendation_flags(spark):
    found = flags(spark, [(i, text, strength) for i, (text, strength, _) in enumerate(CASES)])
    assert found == [expected for _, _, expected in CASES]


def test_flags_agree_with_python_patterns(spark):
    words = ["reduce", "dose", "the", "avoid", "use", "another", "50", "%", "of", "titrating",
             "lower", "start", "with", "a", "not", "recommended", "adjusted", "increase",
             "starting", "switch", "do", "modified", "dosage", "adjustment", "naïve", "x"]
    texts = [" ".join((words * 3)[i:i + 4]) for i in range(60)]
    texts += [a + " " + b for a in words for b in words]
    found = flags(spark, [(i, t, "Strong") for i, t in enumerate(texts)])
    for text, (change, alternative) in zip(texts, found):
        assert change == any(re.search(p, text.lower()) for p in domain.DOSE_CHANGE_PATTERNS)
        assert alternative == any(re.search(p, text.lower()) for p in domain.ALTERNATIVE_PATTERNS)


def test_cross_references(spark):
    values = [
        "ATC:B01AC04,PubChem Compound:60606,RxNorm:32968",
        "ATC:C10AA01, ATC:X ,RxNorm:1:2,DrugBank:DB01234",
        "No cross refs",
        "",
        None,
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    found = df.selectExpr(
        "i", f"{cross_reference_ids('x', 'ATC')} AS a", f"{cross_reference_ids('x', 'RxNorm')} AS r"
    ).orderBy("i").collect()
    assert [(r.a, r.r) for r in found] == [
        ("B01AC04", "32968"), ("C10AA01,X", "1:2"), ("", ""), ("", ""), ("", ""),
    ]


def test_listed_names(spark):
    df = spark.createDataFrame([("A; B ,,c",), (None,), ("",)], "x string")
    found = [r[0] for r in df.selectExpr(listed_names("x")).collect()]
    assert found == [["a", "b", "", "c"], [""], [""]]


def test_small_helpers(spark):
    df = spark.createDataFrame([("x" * 700, " \t Ab　", "12", "12.5")], "a string, b string, c string, d string")
    row = df.selectExpr(summary("a"), name_key("b"), whole_number("c"), whole_number("d")).first()
    assert tuple(row) == ("x" * 500, "ab", 12, None)
    assert all(c.isspace() for c in WHITESPACE)


def test_literals(spark):
    values = ["it's", "back\\slash", "new\nline", True, 3, 0.1, None]
    row = spark.sql("SELECT " + ", ".join(f"{literal(v)} AS c{i}" for i, v in enumerate(values)))
    assert list(row.first()) == values
    with pytest.raises(TypeError):
        literal(object())
    assert lookup("x", {}, "y") == "y"
