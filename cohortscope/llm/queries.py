"""The dealt queries over the given tables, one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscope.llm.alignment import align_tokens
from cohortscope.llm.decontam import find_contaminated
from cohortscope.llm.exact_dedup import exact_dedup
from cohortscope.llm.jaccard import similar_documents
from cohortscope.llm.lines import drop_repeated_lines
from cohortscope.llm.mixing import mix_sources
from cohortscope.llm.quality import score_quality
from cohortscope.llm.spelling import count_words, spelling_variants
from cohortscope.llm.substring import remove_repeated_phrases
from cohortscope.llm.suffixes import remove_repeated_strings
from cohortscope.llm.tokens import count_tokens
from cohortscope.llm.toxicity import score_toxicity
from cohortscope.llm.urls import judge_urls

TOKENIZER, BYTE_TOKENIZER = "piece_bpe_32k.model", "byte_bpe_50k.json"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


def op2_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    return judge_urls(table(spark, sf, "pages"))


def op3_repeated_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeated_phrases(table(spark, sf, "documents"))


def op4_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix_sources(table(spark, sf, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return similar_documents(table(spark, sf, "documents")).drop("digest")


def op6_toxicity_field(spark: SparkSession, sf: str) -> DataFrame:
    return score_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op7_benchmark_templates(spark: SparkSession, sf: str) -> DataFrame:
    return find_contaminated(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")
    ).drop("digest", "n_mapped")


def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op9_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup(table(spark, sf, "documents"), keep="largest")


def op10_repeated_strings(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeated_strings(table(spark, sf, "documents"))


def op11_repeated_lines(spark: SparkSession, sf: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf, "documents"))
    return kept.withColumn("kept_sha256", F.sha2("text", 256)).drop("text")


def op12_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    from public_tokenizers import path

    return align_tokens(table(spark, sf, "documents"), path(BYTE_TOKENIZER), path(TOKENIZER), digest=True)


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(count_words(table(spark, sf, "documents"), typos=97))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_url_filters": op2_url_filters,
    "op3_repeated_phrases": op3_repeated_phrases,
    "op4_source_mixing": op4_source_mixing,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_toxicity_field": op6_toxicity_field,
    "op7_benchmark_templates": op7_benchmark_templates,
    "op8_quality_rules": op8_quality_rules,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_repeated_strings": op10_repeated_strings,
    "op11_repeated_lines": op11_repeated_lines,
    "op12_token_alignment": op12_token_alignment,
    "op13_spelling_variants": op13_spelling_variants,
}
