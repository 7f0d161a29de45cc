"""Runs batch stages: ``spark-submit ... cohortscope/__main__.py STAGE --root PATH``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from cohortscope.operators.quality import MINIMUM_ROWS
from cohortscope.plans import stages
from cohortscope.study import Study

ANNOTATION_TABLES = (
    "pharmgkb_clinical_annotations_raw",
    "pharmgkb_var_drug_ann_raw",
    "pharmgkb_drugs_raw",
    "pharmgkb_genes_raw",
)


def arguments(words: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cohortscope", description=__doc__)
    parser.add_argument(
        "stage",
        choices=[
            "genotypes", "annotations", "guidance", "check", "silver", "gold", "export", "documents",
        ],
    )
    parser.add_argument("--root", required=True, help="folder of all tables")
    parser.add_argument("--database", help="existing database of the catalog that registers the tables")
    parser.add_argument("--sample-buckets", type=int, help="bucket the genotype facts by sample (needs --database)")
    parser.add_argument("--calls-per-file", type=int, help="deal the genotype calls to files by ranges of positions")
    parser.add_argument("--date", type=date.fromisoformat, help="ingest or snapshot date")
    parser.add_argument("--calls", help="variant files")
    parser.add_argument("--panel", help="sample panel")
    parser.add_argument("--recommendations")
    parser.add_argument("--guidelines")
    parser.add_argument("--drugs")
    parser.add_argument(
        "--minimum", action="append", default=[], metavar="TABLE=ROWS",
        help="rows a bronze table needs, instead of the fixed number",
    )
    for table in ANNOTATION_TABLES:
        parser.add_argument(f"--{table}")
    return parser.parse_args(words)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    layout = stages.Layout(args.root.rstrip("/"), args.database, args.sample_buckets, args.calls_per_file)
    day = args.date or date.today()
    study = Study(snapshot_date=day)
    given = (m.partition("=") for m in args.minimum)
    minimum = {**MINIMUM_ROWS, **{table: int(rows) for table, _, rows in given}}
    if args.stage == "genotypes":
        stages.ingest_genotypes(spark, args.calls, args.panel, layout, day, study)
    elif args.stage == "annotations":
        paths = {t: getattr(args, t) for t in ANNOTATION_TABLES if getattr(args, t)}
        stages.ingest_annotations(spark, paths, layout, day)
    elif args.stage == "guidance":
        stages.ingest_guidance(
            spark, args.recommendations, args.guidelines, args.drugs, layout, day
        )
    elif args.stage == "check":
        stages.check_bronze(spark, layout, minimum)
    elif args.stage == "silver":
        stages.check_bronze(spark, layout, minimum)
        stages.build_silver(spark, layout, study, args.date)
    elif args.stage == "gold":
        stages.build_gold(spark, layout, study)
    elif args.stage == "export":
        for name, rows in stages.export_artifacts(spark, layout, study).items():
            print(f"{name}: {rows} rows")
    else:
        stages.publish_documents(spark, layout)


if __name__ == "__main__":
    run(SparkSession.builder.appName("cohortscope").getOrCreate(), arguments())
