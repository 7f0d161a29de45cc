"""Where cohorts differ most from the baseline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope import domain
from cohortscope.functions import literal, lookup
from cohortscope.functions.numbers import decimal_units, tenths
from cohortscope.operators.numbering import number_rows
from cohortscope.schemas import RANKING, conform
from cohortscope.study import Study

SORT = {
    "_score": "DESC NULLS LAST", "drug_name": "ASC", "gene_symbol": "ASC",
    "population_code": "ASC", "classification_strength": "ASC", "delta_vs_baseline": "DESC",
}
ORDER = ", ".join(f"{column} {way}" for column, way in SORT.items())


def sort_columns() -> list[Column]:
    """The ranking's order as columns."""
    ways = {"DESC NULLS LAST": F.desc_nulls_last, "ASC": F.asc, "DESC": F.desc}
    return [ways[way](column) for column, way in SORT.items()]


def implication(study: Study) -> str:
    """The sentence about one row; ``_tenths`` counts tenths of the absolute distance."""
    baseline = literal(f" rate of dose/therapy change vs {study.baseline} in ")
    return (
        f"concat({tenths('_tenths')}, 'pp ', "
        "CASE WHEN delta_vs_baseline > 0 THEN 'higher' ELSE 'lower' END, "
        f"{baseline}, population_code, ' (', drug_name, ' / ', gene_symbol, ', CPIC ', "
        "classification_strength, ')')"
    )


def scored_impact(impact: DataFrame, study: Study) -> DataFrame:
    """Rows of the other cohorts than the baseline, with the score that ranks them."""
    weight = lookup(
        "classification_strength",
        study.strength_weights,
        literal(domain.DEFAULT_STRENGTH_WEIGHT),
    )
    return impact.where(f"NOT (population_code <=> {literal(study.baseline)})").selectExpr(
        "*", f"abs(delta_vs_baseline) * {weight} * percentage_requiring_change AS _score"
    )


def rank_all(
    impact: DataFrame, study: Study, store: Callable[[DataFrame], DataFrame], ranges: int | None = None
) -> DataFrame:
    """Every impact row with its place in the ranking's order, however many rows there are."""
    ranked = number_rows(scored_impact(impact, study), sort_columns(), store, "rank_position", ranges)
    return ranked.drop("_score")


def build_ranking(
    impact: DataFrame, study: Study, top_n: int = domain.RANKING_SIZE
) -> DataFrame:
    """The top rows by score, with every gene's best row among them.

    The best row per gene is a group limit ahead of the exchange. The others compete in one
    ordered limit, of which every task keeps ``top_n`` rows, so the numbering, which has to
    see its rows in one order, gets one row per gene and ``top_n`` more.
    """
    scored = scored_impact(impact, study).selectExpr(
        "*", f"row_number() OVER (PARTITION BY gene_symbol ORDER BY {ORDER}) AS _place"
    )
    fillers = scored.where("_place > 1").orderBy(*sort_columns()).limit(int(top_n))
    # Best rows of the genes first, then the fillers: the first top_n slots are the
    # result, and best rows stay even when there are more genes than slots.
    ranked = (
        scored.where("_place = 1").unionByName(fillers)
        .selectExpr("*", f"row_number() OVER (ORDER BY _place > 1, {ORDER}) AS _slot")
        .where(f"_slot <= {int(top_n)} OR _place = 1")
        .selectExpr(
            "*",
            f"row_number() OVER (ORDER BY {ORDER}) AS rank_position",
            "percentage_requiring_change AS population_affected_pct",
            "abs(delta_vs_baseline) AS _distance",
        )
        .drop("snapshot_date")
        .selectExpr("*", f"CAST({decimal_units('_distance', 1)} AS BIGINT) AS _tenths")
        .selectExpr(
            "*",
            f"{implication(study)} AS clinical_implication",
            f"DATE'{study.snapshot_date}' AS snapshot_date",
        )
    )
    return conform(ranked, RANKING)
