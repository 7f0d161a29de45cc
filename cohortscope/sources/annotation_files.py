"""Tab-separated and JSON sources: panel, annotations, drugs, genes, guidance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscope.operators.clinical import with_cross_references
from cohortscope.schemas import PANEL, RAW_DRUGS, RAW_GUIDELINES, RAW_RECOMMENDATIONS, conform
from cohortscope.sources.record_files import read_records


UNREADABLE = "_unreadable"


@dataclass(frozen=True)
class TableMapping:
    """Header names of a source table: target column -> headers, the newest first."""

    table: str
    columns: Mapping[str, Sequence[str]]
    required: Sequence[str]


# Headers of the published tables.
CLINICAL_ANNOTATIONS = TableMapping(
    "pharmgkb_clinical_annotations_raw",
    {
        "clinical_annotation_id": ["Clinical Annotation ID"],
        "variant_or_haplotype": ["Variant/Haplotypes"],
        "gene_symbol": ["Gene"],
        "drug_names": ["Drug(s)"],
        "phenotype_categories": ["Phenotype Category"],
        "evidence_level": ["Level of Evidence", "Evidence Level"],
        "clinical_annotation_types": ["Clinical Annotation Types"],
        "pediatric": ["Pediatric"],
        "annotation_text": ["Sentence"],
        "url": ["URL"],
    },
    ["Clinical Annotation ID", "Gene"],
)
DRUG_ANNOTATIONS = TableMapping(
    "pharmgkb_var_drug_ann_raw",
    {
        "annotation_id": ["Variant Annotation ID", "Annotation ID"],
        "variant_rsid": ["Variant/Haplotypes"],
        "gene_symbol": ["Gene"],
        "drug_name": ["Drug(s)"],
        "pmid": ["PMID"],
        "phenotype_category": ["Phenotype Category"],
        "significance": ["Significance"],
        "notes": ["Notes"],
        "sentence": ["Sentence"],
        "alleles": ["Alleles"],
    },
    ["Gene"],
)
DRUGS = TableMapping(
    "pharmgkb_drugs_raw",
    {
        "pharmgkb_drug_id": ["PharmGKB Accession Id"],
        "drug_name": ["Name"],
        "generic_names": ["Generic Names"],
        "trade_names": ["Trade Names"],
        "drug_type": ["Type"],
        "_cross_references": ["Cross-references"],
    },
    ["PharmGKB Accession Id", "Name"],
)
GENES = TableMapping(
    "pharmgkb_genes_raw",
    {
        "pharmgkb_gene_id": ["PharmGKB Accession Id"],
        "gene_symbol": ["Symbol"],
        "ensembl_id": ["Ensembl Id"],
        "ncbi_gene_id": ["NCBI Gene ID"],
        "chromosome": ["Chromosome"],
        "chromosomal_start": ["Chromosomal Start (GRCh37)"],
        "chromosomal_end": ["Chromosomal End (GRCh37)"],
    },
    ["PharmGKB Accession Id", "Symbol"],
)
PANEL_COLUMNS = TableMapping(
    "samples_metadata_raw",
    {
        "sample_id": ["sample"],
        "population_code": ["pop"],
        "superpopulation": ["super_pop"],
        "sex": ["gender", "sex"],
        "family_id": ["family_id"],
    },
    ["sample", "pop", "super_pop"],
)


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, empty fields as empty strings, lines starting with # skipped.

    Quoted fields may hold line breaks, so a file is read by one task; these are published
    tables of some thousand rows. A row with more fields than the header fails the read and is
    named; one with fewer is filled up.
    """
    options = {
        "sep": "\t", "header": True, "comment": "#", "escape": '"', "multiLine": True,
        "enforceSchema": False,
    }
    names = spark.read.options(**options).csv(path).columns
    fields = ", ".join(f"`{n}` string" for n in names)
    raw = (
        spark.read.options(**options, columnNameOfCorruptRecord=UNREADABLE)
        .schema(f"{fields}, `{UNREADABLE}` string")
        .csv(path)
        .na.fill("", names)
    )
    tabs = f"length({UNREADABLE}) - length(replace({UNREADABLE}, '\t', ''))"
    complaint = f"concat('more fields than the header has: ', {UNREADABLE})"
    first = names[0].replace("`", "``")
    checked = F.expr(
        f"CASE WHEN {tabs} >= {len(names)} THEN raise_error({complaint}) ELSE `{first}` END"
    )
    return raw.select(checked.alias(names[0]), *[F.col(f"`{n}`") for n in names[1:]])


def map_columns(raw: DataFrame, mapping: TableMapping) -> DataFrame:
    """Target columns from their headers; optional ones that are absent are null."""
    missing = [c for c in mapping.required if c not in raw.columns]
    if missing:
        raise RuntimeError(
            f"{mapping.table}: required columns not found: {missing}; got {sorted(raw.columns)}"
        )

    def source(headers: Sequence[str]):
        present = [F.col(f"`{h}`") for h in headers if h in raw.columns]
        return F.coalesce(*present) if present else F.lit(None).cast("string")

    return raw.select([source(headers).alias(name) for name, headers in mapping.columns.items()])


def read_annotations(spark: SparkSession, path: str, mapping: TableMapping) -> DataFrame:
    mapped = map_columns(read_tsv(spark, path), mapping)
    return with_cross_references(mapped) if mapping is DRUGS else mapped


def build_panel(raw: DataFrame) -> DataFrame:
    return conform(map_columns(raw, PANEL_COLUMNS), PANEL)


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    return build_panel(spark.read.csv(path, sep="\t", header=True, enforceSchema=False))


def read_guidelines(spark: SparkSession, path: str) -> DataFrame:
    return read_records(spark, path, RAW_GUIDELINES)


def read_drug_names(spark: SparkSession, path: str) -> DataFrame:
    named = read_records(spark, path, RAW_DRUGS)
    return named.where("drugid <> '' AND name <> ''")


def read_recommendations(spark: SparkSession, path: str) -> DataFrame:
    return read_records(spark, path, RAW_RECOMMENDATIONS)
