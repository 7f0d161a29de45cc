"""The first annotation of a variant, gene and drug."""

from __future__ import annotations

import random
import re

from cohortscope.operators.clinical import build_clinical_variants
from cohortscope.operators.dedup import first_bytes

IDS = (
    None, "", "1", "10", "9", "é1", "z", "annotation-number-000002", "annotation-number-000001",
    "annotation-number", "\U0001f600",
)
COLUMNS = (
    "clinical_annotation_id string, variant_or_haplotype string, gene_symbol string, drug_names string, "
    "evidence_level string, annotation_text string"
)


def test_first_bytes_keep_the_order(spark):
    texts = sorted((i for i in IDS if i is not None), key=lambda t: t.encode())
    ordered = [None, *texts]
    found = spark.createDataFrame(list(enumerate(ordered)), "n int, t string").selectExpr(
        "n", f"{first_bytes('t')} AS start"
    )
    starts = [r.start for r in sorted(found.collect(), key=lambda r: r.n)]
    assert starts == sorted(starts) and starts[0] < starts[1] and len(set(starts)) == len(IDS) - 2


def test_first_annotation_by_id_entry_and_columns(spark, study):
    gene = sorted(study.scope_genes)[0]
    pick = random.Random(1)
    rows = [
        (pick.choice(IDS), pick.choice(["rs1", "rs2", None]), gene, pick.choice(["A; b", "b,a", None, "a,A"]),
         pick.choice(["1A", "3", None]), pick.choice(["long text", "a", None]))
        for _ in range(400)
    ]
    annotations = spark.createDataFrame(rows, COLUMNS)
    expected = {}
    for id_, variant, _, drugs, level, text in rows:
        for entry, drug in enumerate(re.split("[,;]", drugs or "")):
            key = (variant, drug.strip().lower())
            order = (id_ is not None, (id_ or "").encode(), entry, level is not None, level or "", text or "")
            expected[key] = min(expected.get(key, order), order)
    found = build_clinical_variants(annotations, study)
    assert {(r.variant_rsid, r.drug_name): (r.evidence_level, r.annotation_summary) for r in found.collect()} == {
        key: (order[4] or None, order[5]) for key, order in expected.items()
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[variant_rsid" in plan and "min(_start" in plan  # no wide row is sorted for it
    without = build_clinical_variants(annotations.drop("clinical_annotation_id"), study)
    assert without.count() == len(expected)
