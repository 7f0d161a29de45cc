"""SQL expressions on texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed by the contracts: a word is a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole_text(text: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; texts of one byte per character take the short way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def crc_fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % folds


def keep_rows(docs: DataFrame, kept: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Rows of docs whose keys are in kept, each key once, with the columns of docs.

    ``keys`` maps column names of kept to expressions over docs. A null key equals a null key.
    Rows that agree in all keys are repetitions and one of them stays; whether there are any is
    looked up first, as removing them costs one more exchange of whole rows.
    """
    own = {name: f"__key_{i}" for i, name in enumerate(keys)}
    marked = docs.withColumns({own[name]: value for name, value in keys.items()})
    wanted = kept.select(*[F.col(name).alias(f"__kept_{i}") for i, name in enumerate(keys)])
    wanted = wanted.distinct()
    same = [F.col(f"__key_{i}").eqNullSafe(F.col(f"__kept_{i}")) for i in range(len(keys))]
    rows = marked.join(wanted.hint("shuffle_hash"), same, "left_semi")
    repeated = marked.groupBy(*own.values()).count().where("count > 1").limit(1)
    if not repeated.isEmpty():
        rows = rows.dropDuplicates(list(own.values()))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
