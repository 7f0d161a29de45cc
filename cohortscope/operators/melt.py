"""Wide variant records to one row per variant and sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.functions.genome import touches_regions
from cohortscope.operators.dedup import keep_first
from cohortscope.schemas import GENOTYPES, conform
from cohortscope.study import Study

FIXED_FIELDS = 9

CALL_ORDER = ("chromosome", "position", "reference_allele", "alternate_allele", "genotype")

# Dosage of the common calls; any other call is taken apart.
COMMON_DOSAGES = {
    "0|0": 0, "0|1": 1, "1|0": 1, "1|1": 2, "0/0": 0, "0/1": 1, "1/0": 1, "1/1": 2, "0": 0, "1": 1,
}


def parse_records(lines: DataFrame, study: Study | None = None) -> DataFrame:
    """Variant lines (header, value) to records, sample fields still one text.

    Only the nine leading fields are split here, so records outside the study's regions
    cost no more than that. The fields come out of a one-element ``inline``: filters on
    them then stay above it, where a plain projection would have its ``split`` copied
    into every term of the region filter. Sites without exactly one alternate allele
    are dropped.
    """
    chromosome = "get(f, 0)"
    position = "CAST(get(f, 1) AS BIGINT)"
    fields = {
        "chromosome": f"CASE WHEN startswith({chromosome}, 'chr') THEN {chromosome} "
        f"ELSE concat('chr', {chromosome}) END",
        "position": position,
        "id": "get(f, 2)",
        "reference_allele": "get(f, 3)",
        "alternate_allele": "get(f, 4)",
        "quality": "get(f, 5)",
        "filter_status": "get(f, 6)",
        # An indexed fetch goes by the length of the reference allele or the END tag.
        "last_position": f"greatest({position} + length(get(f, 3)) - 1, "
        r"try_cast(regexp_extract(get(f, 7), '(?:^|;)END=(\\d+)', 1) AS BIGINT))",
        "format": "get(f, 8)",
        "calls": "get(f, 9)",
    }
    struct = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    records = (
        lines.where("NOT startswith(value, '#')")
        .selectExpr("header", f"split(value, '\\t', {FIXED_FIELDS + 1}) AS f")
        .selectExpr("header", f"inline(array(named_struct({struct})))")
        .where("alternate_allele <> '.' AND NOT contains(alternate_allele, ',')")
    )
    if study is not None:
        records = records.where(
            touches_regions(
                "chromosome", "position", "last_position", study.regions, study.region_buffer
            )
        )
    return records.drop("last_position")


def header_samples(columns: DataFrame) -> DataFrame:
    """(header, names, repeats): one row per header from (header, column_index, sample_id).

    ``names`` has the sample of each column, null where it is not wanted; ``repeats`` says
    whether a sample has several columns.
    """
    listed = "sort_array(collect_list(struct(column_index, sample_id)))"
    gathered = columns.groupBy("header").agg(
        F.expr(listed).alias("_listed"), F.max("column_index").alias("_last")
    )
    by_index = "map_from_entries(_listed)"
    return gathered.selectExpr(
        "header",
        f"transform(sequence(0, CAST(_last AS INT)), i -> try_element_at({by_index}, i)) AS names",
        "size(array_distinct(_listed.sample_id)) < size(_listed) AS repeats",
    )


def identified(records: DataFrame) -> DataFrame:
    """Records that hold genotypes, with the id of their variant."""
    return records.where("substring_index(format, ':', 1) = 'GT'").withColumn(
        "variant_id",
        F.expr(
            "CASE WHEN coalesce(id, '.') IN ('.', '') THEN concat(chromosome, ':', position) "
            "ELSE id END"
        ),
    )


def melt_genotypes(records: DataFrame) -> DataFrame:
    """One row per identified record (with its header's names) and wanted complete call.

    Calls of other samples are dropped inside the array, before rows are made of it.
    """
    named = "transform(split(calls, '\\t'), (c, i) -> struct(get(names, i) AS sample_id, c AS call))"
    calls = (
        records.selectExpr(
            "chromosome",
            "position",
            "variant_id",
            "reference_allele",
            "alternate_allele",
            "try_cast(quality AS DOUBLE) AS quality",
            "CASE WHEN coalesce(filter_status, '.') IN ('.', '') THEN 'PASS' "
            "ELSE filter_status END AS filter_status",
            f"inline(filter({named}, x -> x.sample_id IS NOT NULL))",
        )
        .selectExpr("*", "substring_index(call, ':', 1) AS _alleles")
        .where("_alleles <> '' AND NOT contains(_alleles, '.')")
    )
    common = " ".join(f"WHEN '{call}' THEN {dosage}" for call, dosage in COMMON_DOSAGES.items())
    counted = "size(filter(split(_alleles, '[|/]'), a -> CAST(a AS INT) > 0))"
    melted = calls.selectExpr(
        "*",
        f"CASE _alleles {common} ELSE {counted} END AS allele_dosage",
        # One unphased separator makes the whole call unphased.
        "CASE WHEN contains(_alleles, '/') THEN translate(_alleles, '|', '/') "
        "ELSE _alleles END AS genotype",
        "CAST(NULL AS STRING) AS info_payload",
    )
    return conform(melted, GENOTYPES)


def assemble_variants(records: DataFrame, columns: DataFrame) -> DataFrame:
    """One row per variant and sample; repeated records keep the first call by position.

    Whether calls can repeat is decided on the records, a row per site: only variants with
    several records, and headers that list a sample twice, need the deduplication. Their
    calls take it; the calls of all others are never shuffled. The header table is as large
    as the header text, which the reader holds, and is broadcast.
    """
    sites = identified(records)
    repeated = sites.groupBy("variant_id").count().where("count > 1").selectExpr(
        "variant_id", "TRUE AS _repeated"
    )
    marked = (
        sites.join(F.broadcast(header_samples(columns)), "header")
        .join(repeated, "variant_id", "left")
        .withColumn("_repeated", F.expr("repeats OR coalesce(_repeated, FALSE)"))
    )
    single = melt_genotypes(marked.where("NOT _repeated"))
    several = melt_genotypes(marked.where("_repeated"))
    first = keep_first(several, ["variant_id", "sample_id"], CALL_ORDER)
    return single.unionByName(first.select(*single.columns))
