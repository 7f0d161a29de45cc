"""Line deduplication with a sharded minimal perfect hash.

The distinct lines' 128-bit hashes are dealt out to shards. A minimal perfect hash numbers the
lines of a shard, and arrays in that order hold a fingerprint, the number of documents and the
largest document id of each line. Documents' lines are sent to their shard as hashes and look
their place in the arrays up; no line is joined to a line, and no text is moved but once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from cohortscope.llm.grams import mix
from cohortscope.llm.scratch import Scratch
from cohortscope.llm.texts import whole_text

#: Distinct lines of a shard, and looked-up lines that one task holds, on average.
SHARD_LINES, TASK_LINES = 500_000, 1_000_000
_BLANKS = b" \t\n\x0b\x0c\r"
_STEP = 0x9E3779B97F4A7C15
_MOST = np.iinfo(np.uint32).max


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The 128-bit hash of a stripped line with A-Z lower-cased; None for a shorter line."""
    key = line.strip(_BLANKS).lower()  # lower() of bytes changes A-Z only
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8")) < min_chars):
        return None
    return hashlib.md5(key, usedforsecurity=False).digest()


class PerfectHash:
    """Numbers n distinct 128-bit keys from 0 to n - 1, in some 3 bits a key.

    Each level has two slots for each key that is left. A key that has its slot for itself stays
    there, the others go on to the next level. A key's number is the count of taken slots before its own.
    """

    def __init__(self, sizes: list[int], bits: bytes):
        self.sizes = sizes
        self.taken = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        self.before = np.cumsum(self.taken) - self.taken

    @staticmethod
    def slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        turned = mix(keys[:, 1] + np.uint64((2 * level + 1) * _STEP % 2**64))
        return (mix(keys[:, 0] ^ turned) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(keys):
            size = -(-2 * len(keys) // 64) * 64
            slot = cls.slots(keys, len(sizes), size)
            alone = np.bincount(slot, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone))
            keys = keys[~alone[slot]]
        return cls(sizes, np.concatenate(levels).tobytes() if levels else b"")

    @property
    def bits(self) -> bytes:
        return np.packbits(self.taken).tobytes()

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers; -1 or any number for a key it was not made of."""
        found = np.full(len(keys), -1, dtype=np.int64)
        left, first = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = first + self.slots(keys[left], level, size)
            here = self.taken[at]
            found[left[here]] = self.before[at[here]]
            left, first = left[~here], first + size
        return found


def _keys(column: pa.ChunkedArray) -> np.ndarray:
    """128-bit hashes as rows of two numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u8").astype(np.uint64).reshape(-1, 2)


def _lines(min_chars: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column("text").cast(pa.large_binary())):
                keys = {line_key(line, min_chars) for line in text.as_py().split(b"\n")} - {None}
                rows += [row] * len(keys)
                found += keys
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("row").take(at), pa.array(found, pa.binary())],
                ["doc_id", "row", "line"],
            )

    return hashed


def _shard(lines: pa.Table) -> pa.Table:
    """The index of one shard: its perfect hash, and arrays in the order of its numbers."""
    keys = _keys(lines.column("line"))
    index = PerfectHash.of(keys)
    order = np.argsort(index.numbers(keys))
    n_docs = np.minimum(lines.column("n_docs").to_numpy()[order], _MOST).astype(np.uint32)
    owner = lines.column("owner").combine_chunks().take(pa.array(order))
    return pa.table(
        {
            "shard": lines.column("shard")[:1],
            "sizes": pa.array([index.sizes], pa.list_(pa.int64())),
            "bits": pa.array([index.bits], pa.binary()),
            "fingerprints": pa.array([keys[order, 1].astype(np.uint32).tobytes()], pa.binary()),
            "n_docs": pa.array([n_docs.tobytes()], pa.binary()),
            "owners": pa.array([owner.to_pylist()], pa.list_(owner.type)),
        }
    )


def _probe(min_docs: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def probe(shard: pa.Table, lines: pa.Table) -> pa.Table:
        """The lines that go: found in enough documents, in another than the owner."""
        out = lines.select(["doc_id", "row", "line"])
        if not len(shard) or not len(lines):
            return out.slice(0, 0)
        one = {name: shard.column(name)[0] for name in shard.column_names}
        keys = _keys(lines.column("line"))
        number = PerfectHash(one["sizes"].as_py(), one["bits"].as_py()).numbers(keys)
        prints = np.frombuffer(one["fingerprints"].as_py(), np.uint32)
        known = (number >= 0) & (prints[number] == keys[:, 1].astype(np.uint32))
        often = known & (np.frombuffer(one["n_docs"].as_py(), np.uint32)[number] >= min_docs)
        places = np.flatnonzero(often)
        out = out.take(pa.array(places))
        owner = one["owners"].values.take(pa.array(number[places]))
        ids = out.column("doc_id").combine_chunks()
        own = pc.or_(pc.fill_null(pc.equal(ids, owner), False), pc.and_(ids.is_null(), owner.is_null()))
        return out.filter(pc.invert(own))

    return probe


def _kept(min_chars: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, texts = [], [], []
            for text, gone in zip(batch.column("text").cast(pa.large_binary()), batch.column("gone")):
                lines = text.as_py().split(b"\n")
                drop = set(gone.as_py() or ())
                kept = [x for x in lines if line_key(x, min_chars) not in drop] if drop else lines
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
                texts.append(b"\n".join(kept))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_lines, pa.int64()),
                    pa.array(n_dropped, pa.int64()),
                    pa.array(texts, pa.large_binary()).cast(batch.schema.field("text").type),
                ],
                ["doc_id", "n_lines", "n_dropped", "text"],
            )

    return rebuilt


def drop_repeated_lines(docs: DataFrame, *, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per row of docs: doc_id, n_lines, n_dropped, text (what is left).

    Texts are split at line feeds. Lines are equal when they are after stripping ASCII white space
    at both ends and lower-casing A-Z. A line of at least ``min_chars`` code points that at least
    ``min_docs`` documents hold goes from all of them but the one with the largest id, where each
    of its places stays. The other lines stay as they are, joined by line feeds.

    Null and empty text: one empty line. Rows that share an id are one document; rows of null id
    too, with the smallest id of all. Ids of any type that sorts. Empty table: no rows. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    kind: DataType = docs.schema["doc_id"].dataType
    doc = f"doc_id {kind.simpleString()}"
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    row_lines = f"{doc}, row long, line binary"
    lines = scratch.store(texts.mapInArrow(_lines(min_chars), row_lines), "lines")
    counts = scratch.store(
        lines.groupBy("line").agg(
            (F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull()).cast("long")).alias("n_docs"),
            F.max("doc_id").alias("owner"),
        ),
        "counts",
    )
    shards = -(-counts.count() // SHARD_LINES) or 1
    parts = -(-lines.count() // (shards * TASK_LINES)) or 1
    shard = F.pmod(F.xxhash64("line"), F.lit(shards)).alias("shard")
    index = scratch.store(
        counts.select("*", shard).groupBy("shard").applyInArrow(
            _shard,
            "shard long, sizes array<long>, bits binary, fingerprints binary, n_docs binary, "
            f"owners array<{kind.simpleString()}>",
        ),
        "index",
    )
    # The lines of a shard are looked up in several tasks, each with the shard's arrays.
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part")
    gone = (
        index.select("*", every_part).groupBy("shard", "part")
        .cogroup(lines.select("*", shard, F.pmod("row", F.lit(parts)).alias("part")).groupBy("shard", "part"))
        .applyInArrow(_probe(min_docs), row_lines)
        .groupBy("doc_id", "row").agg(F.collect_set("line").alias("gone"))
        .select(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row"), "gone")
    )
    same = (F.col("row") == F.col("gone_row")) & F.col("doc_id").eqNullSafe(F.col("gone_id"))
    marked = texts.join(gone.hint("shuffle_hash"), same, "left").select("doc_id", "text", "gone")
    return marked.mapInArrow(_kept(min_chars), f"{doc}, n_lines long, n_dropped long, text string")
