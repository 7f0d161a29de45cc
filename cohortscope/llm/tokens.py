"""Token counts with a digest cache: only texts that no call has counted are encoded."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.scratch import Scratch
from cohortscope.llm.texts import whole_text

CACHE = "tokenizer string, content binary, n_tokens long"


def sentencepiece_counter(model: bytes) -> Callable[[str], int]:
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    return lambda text: len(processor.encode(text))


def json_counter(model: bytes) -> Callable[[str], int]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(model.decode("utf-8"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def tokenizer_digest(kind: str, model: bytes) -> str:
    """Names the tokenizer's version: its kind and the content of its file."""
    return hashlib.sha256(kind.encode() + b"\0" + model).hexdigest()


def count_tokens(
    docs: DataFrame, tokenizer: str, *, cache: str | None = None, limit: int = 4096
) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``tokenizer`` is the path of a .model or .json file on the driver; its content goes to the
    tasks, so every task encodes with the version that the digest names. ``cache`` is a folder of
    earlier counts in a store that all executors share; without it the call uses a new one.
    Contents are joined to the cache by SHA-256 of the text and the tokenizer's digest. Each
    content that is missing is encoded once, whole, and its count is appended. No
    normalisation but null as empty: any other could change the counts that the library gives.

    Empty and null texts: counted as the library counts an empty text. Null and repeated ids:
    each row has its count. Empty table: no rows. Other columns are ignored. Two calls that add
    the same content at once leave two equal rows, of which one is read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-counts")
    cache = cache or f"{scratch.folder}/cache"
    with open(tokenizer, "rb") as file:
        model = file.read()
    kind = "sentencepiece" if tokenizer.endswith(".model") else "tokenizers"
    version = tokenizer_digest(kind, model)
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn(
        "content", F.unhex(F.sha2("text", 256))
    )
    narrow = scratch.store(
        texts.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes")), "contents"
    )
    # A first, empty write makes a new cache readable.
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("tokenizer").parquet(cache)
    missing = narrow.groupBy("content").agg(F.min("doc_id").alias("id")).join(
        _stored(spark, cache, version), "content", "left_anti"
    )
    wanted = missing.withColumnRenamed("content", "missed").hint("shuffle_hash")
    same = (F.col("content") == F.col("missed")) & F.col("doc_id").eqNullSafe(F.col("id"))
    counted = _encoded(texts.join(wanted, same).select("content", "text"), kind, model)
    (
        counted.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
        .withColumn("tokenizer", F.lit(version))
        .write.mode("append").partitionBy("tokenizer").parquet(cache)
    )
    return narrow.join(_stored(spark, cache, version), "content", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def _stored(spark, cache: str, version: str) -> DataFrame:
    rows = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _encoded(texts: DataFrame, kind: str, model: bytes) -> DataFrame:
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = {"sentencepiece": sentencepiece_counter, "tokenizers": json_counter}[kind](model)
        for batch in batches:
            counts = [counter(text) for text in batch["text"]]
            yield pd.DataFrame({"content": batch["content"], "n_tokens": counts})

    return texts.mapInPandas(encode, "content binary, n_tokens long")
