"""Lines of block-gzip files, read by many tasks.

Block gzip is a row of gzip members of at most 64 KB of data, each of which states its own length in
its header. So a file can be entered anywhere: a task gets a range of bytes, looks for the
first member that starts in it, and follows the stated lengths from there. As with splits of plain
text, the line that crosses the end of a range belongs to the task of that range, and every
task but a file's first skips what precedes its first line feed.

Plain gzip has no such lengths; the task of a file's first range streams it whole. Files are opened
with Arrow's file systems (local, hdfs, s3, gs), as Spark's readers do not split ``.gz`` files.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import takewhile
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

#: Compressed bytes of a range, and bytes that are read or handed on at once.
RANGE, PIECE = 32 << 20, 1 << 20
#: Fixed by the format: start of a member with extra fields, and its largest length.
MEMBER, LONGEST = b"\x1f\x8b\x08\x04", 1 << 16
PACKED = "[.]b?gz$"
#: A file's name, which readers write with one slash or three.
FILE = "regexp_replace(_metadata.file_path, '^file:/+', 'file:///')"


def opened(uri: str) -> pa.NativeFile:
    """A file by the name that Spark gives it, a URI."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(unquote(re.sub("^file:/+", "/", uri)))
    system, inner = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))
    return system.open_input_file(inner)


def member_size(data: bytes, at: int = 0) -> int | None:
    """Length of the member that starts here; None if none does that states it."""
    if data[at : at + 4] != MEMBER or len(data) < at + 18:
        return None
    extra, stop = at + 12, at + 12 + int.from_bytes(data[at + 10 : at + 12], "little")
    while extra + 4 <= stop:
        size = int.from_bytes(data[extra + 2 : extra + 4], "little")
        if data[extra : extra + 2] == b"BC" and size == 2:
            return int.from_bytes(data[extra + 4 : extra + 6], "little") + 1
        extra += 4 + size
    return None


def unpacked(member: bytes) -> bytes | None:
    """The data of a member; None if it does not agree with its checksum."""
    head = 12 + int.from_bytes(member[10:12], "little")
    try:
        data = zlib.decompress(member[head:-8], wbits=-15)
    except zlib.error:
        return None
    return data if zlib.crc32(data) == int.from_bytes(member[-8:-4], "little") else None


def first_member(file: pa.NativeFile, begin: int, end: int, length: int) -> int | None:
    """Where the first member at or after ``begin`` starts, if before ``end``.

    The four bytes may lie inside a member by chance: its data has to agree with its checksum, and
    another member or the end of the file to follow. A damaged member is passed over here, but the
    task of the range before comes to it from its own members and fails.
    """
    file.seek(begin)
    data = file.read(min(2 * LONGEST + 64, length - begin))
    at = data.find(MEMBER)
    while at >= 0 and begin + at < end:
        size = member_size(data, at)
        if (
            size is not None
            and (begin + at + size == length or member_size(data, at + size) is not None)
            and unpacked(data[at : at + size]) is not None
        ):
            return begin + at
        at = data.find(MEMBER, at + 1)
    return None


def members(file: pa.NativeFile, begin: int, length: int, name: str) -> Iterator[tuple[int, bytes]]:
    """Start and data of every member from ``begin`` to the end of the file."""
    data, base = b"", begin
    at = begin
    while at < length:
        if at - base + LONGEST > len(data) and base + len(data) < length:
            file.seek(at)
            data, base = file.read(PIECE + LONGEST), at
        size = member_size(data, at - base)
        member = data[at - base : at - base + (size or 0)]
        if size is None or len(member) < size:
            raise ValueError(f"{name}: no whole block at byte {at}")
        text = unpacked(member)
        if text is None:
            raise ValueError(f"{name}: wrong checksum of the block at byte {at}")
        yield at, text
        at += size


def streamed(file: pa.NativeFile, name: str) -> Iterator[bytes]:
    """The data of a plain file, or of all members of a gzip file."""
    file.seek(0)
    data = file.read(PIECE)
    if data[:2] != b"\x1f\x8b":
        while data:
            yield data
            data = file.read(PIECE)
        return
    unpack = zlib.decompressobj(wbits=31)
    while data or (data := file.read(PIECE)):
        yield unpack.decompress(data, 4 * PIECE)
        data = unpack.unconsumed_tail
        if unpack.eof:
            data = unpack.unused_data or file.read(PIECE)
            if not data:
                return
            unpack = zlib.decompressobj(wbits=31)  # another member follows
    raise ValueError(f"{name}: ends within a gzip member")


def range_pieces(file: pa.NativeFile, begin: int, end: int, length: int, name: str) -> Iterator[bytes]:
    """Whole lines of one range in pieces that end with a line feed, but a file's last."""
    file.seek(0)
    if member_size(file.read(4096)) is None:
        pieces: Iterator[tuple[int, bytes]] = ((0, x) for x in streamed(file, name)) if begin == 0 else iter(())
    else:
        start = first_member(file, begin, end, length) if begin else 0
        pieces = members(file, start, length, name) if start is not None else iter(())
    rest, skipping = b"", begin > 0
    for at, data in pieces:
        beyond = at >= end
        if skipping:
            if beyond:
                return  # no line starts in this range
            _, found, data = data.partition(b"\n")
            skipping = not found
        if skipping or not data:
            continue
        cut = data.find(b"\n") + 1 if beyond else data.rfind(b"\n") + 1
        if cut and (beyond or len(rest) + cut >= PIECE):
            yield rest + data[:cut]
            rest = data[cut:]
        else:
            rest += data
        if beyond and cut:
            return
    if rest:
        yield rest


def _lines(heads: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with opened(row["file"]) as file:
                    if heads:
                        pieces = range_pieces(file, 0, row["length"], row["length"], row["file"])
                    else:
                        pieces = range_pieces(file, row["begin"], row["end"], row["length"], row["file"])
                    for piece in pieces:
                        lines = [x.removesuffix(b"\r") for x in piece.removesuffix(b"\n").split(b"\n")]
                        found = list(takewhile(lambda x: x.startswith(b"#"), lines)) if heads else lines
                        values = pa.array(found, pa.binary()).cast(pa.string())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row["file"]] * len(found), pa.string()), values], ["file", "value"]
                        )
                        if heads and len(found) < len(lines):
                            break

    return read


def listed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, length) of all files; their content is not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.selectExpr(f"{FILE} AS file", "length").where("length > 0")


def packed_lines(spark: SparkSession, path: str | list[str], *, size: int = RANGE) -> DataFrame:
    """(file, value): the lines of all ``.gz`` and ``.bgz`` files, one task for each ``size`` bytes.

    A file of plain gzip is one task. A cut or damaged block fails the query with its place.
    """
    ranges = listed(spark, path).where(f"file RLIKE '{PACKED}'").selectExpr(
        "file", "length", f"explode(sequence(0L, (length - 1) div {size})) AS number"
    ).selectExpr("file", "length", f"number * {size} AS begin", f"least((number + 1) * {size}, length) AS end")
    tasks = ranges.count()
    return ranges.repartition(max(tasks, 1)).mapInArrow(_lines(False), "file string, value string")


def head_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, value): the lines that start with # before each file's first other line.

    However large a file is, only its first piece or pieces are read, compressed or not.
    """
    return listed(spark, path).mapInArrow(_lines(True), "file string, value string")


def read_ranges(uri: str, size: int, text: bool = True) -> list:
    """The lines of one file, range after range, in this process: for looking at a file."""
    found: list = []
    with opened(uri) as file:
        length = file.size()
        for begin in range(0, length, size):
            for piece in range_pieces(file, begin, min(begin + size, length), length, uri):
                found += piece.removesuffix(b"\n").split(b"\n")
    return [line.decode() for line in found] if text else found
