"""Exact duplicates: a 128-bit content hash, a stable survivor, bytes compared inside groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.scratch import Scratch
from cohortscope.llm.texts import ascii_lower, keep_rows, whole_text


def exact_dedup(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are equal after lower-casing A-Z. ``keep`` names the id
    that stays, "smallest" or "largest". Only hashes are grouped over all documents; the bytes
    are compared where a hash occurs twice, by grouping those rows by the text itself, so two
    texts that share a hash stay apart. Copies collapse before each exchange, and a hash that
    a third of the rows share meets only joins that Spark may split.

    Null text: empty, and empty texts are copies of each other. A null id loses against any id;
    a group of null ids has a null keep_id and one of its rows stays. Of rows repeated with id
    and text one stays. Empty table: no rows. Other columns are ignored.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    text = ascii_lower(whole_text())
    texts = docs.select("doc_id", F.md5(text.cast("binary")).alias("hash"), text.alias("text"))
    narrow = texts.select("doc_id", "hash", F.sha2(F.col("text"), 256).alias("text_sha256"))
    rows = scratch.store(narrow.groupBy(*narrow.columns).agg(F.count("*").alias("times")), "rows")
    shared = scratch.store(
        rows.groupBy("hash").agg(F.sum("times").alias("n")).where("n > 1").select("hash"), "shared"
    )
    # A hash join at every size: whole texts are moved but never sorted.
    members = scratch.store(
        texts.join(shared.hint("shuffle_hash"), "hash", "left_semi").withColumn(
            "text_sha256", F.sha2(F.col("text"), 256)
        ),
        "members",
    )
    classes = scratch.store(
        members.groupBy("hash", "text").agg(
            pick("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        ),
        "classes",
    )
    single = rows.join(shared, "hash", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        "text_sha256", "times",
    )
    grouped = (
        members.join(classes, ["hash", "text"])
        .groupBy("doc_id", "keep_id", "group_size", "text_sha256")
        .agg(F.count("*").alias("times"))
    )
    every = single.unionByName(grouped).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), "times"))
    )
    return every.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """Rows of docs that stay, with all their columns."""
    kept = exact_dedup(docs, keep).where("kept").select("doc_id", "text_sha256")
    text = F.sha2(ascii_lower(whole_text()), 256)
    return keep_rows(docs, kept, {"doc_id": F.col("doc_id"), "text_sha256": text})
