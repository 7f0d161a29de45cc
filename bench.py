"""Times the headline queries; prints one JSON line.

Each query runs three times in one session and the better of the last two runs counts:
the first one pays for class loading and code generation, once per executor on a cluster.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortscope.plans.queries import QUERIES  # noqa: E402
from cohortscope.session import local_session  # noqa: E402

HEADLINE = (
    "silver_variants",
    "gene_assignment",
    "allele_frequencies",
    "individual_dosage",
    "phenotype_distribution",
    "drug_recommendations",
    "drug_impact",
    "joint_impact",
    "actionability_ranking",
    "clinical_variants",
    "guideline_flatten",
    "genotype_melt",
    "export_metadata",
    "knowledge_documents",
)


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores)
    names = sys.argv[1:] or HEADLINE
    timings = {}
    for name in names:
        runs = [seconds(spark, name, sf_dir) for _ in range(3)]
        timings[name] = round(min(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
