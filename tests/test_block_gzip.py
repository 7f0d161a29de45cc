"""Compressed variant files: the same lines as plain ones, whatever the ranges."""

from __future__ import annotations

import gzip
import os
import random
import struct
import zlib

import pytest
from checks import rows
from test_sources import panel, record, variant_file

from cohortscope.sources import block_gzip, variant_files
from cohortscope.sources.block_gzip import head_lines, packed_lines, read_ranges


def block(data, level=6):
    packer = zlib.compressobj(level, wbits=-15)
    body = packer.compress(data) + packer.flush()
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<H", 2)
    return head + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def pack(path, text, sizes, level=6):
    """Blocks of the sizes in turn, and the empty one at the end of such files."""
    data, at, n = text.encode(), 0, 0
    with open(path, "wb") as out:
        while at < len(data):
            out.write(block(data[at : at + sizes[n % len(sizes)]], level))
            at += sizes[n % len(sizes)]
            n += 1
        out.write(block(b""))
    return path


def values(df):
    return sorted(r.value for r in df.collect())


TEXT = "".join(f"line {i} " + "x" * random.Random(i).choice([0, 3, 50, 400, 9000]) + "\n" for i in range(400))


@pytest.mark.parametrize("sizes", [(60_000,), (1, 700, 13), (9_016,)])
@pytest.mark.parametrize("size", [97, 1000, 20_000, 1 << 30])
def test_lines_of_ranges(folder, sizes, size):
    path = pack(f"{folder}/a.vcf.gz", TEXT, sizes)
    found = read_ranges(f"file:{path}", size)
    assert found == TEXT.splitlines()


def test_lines_by_many_tasks(spark, folder):
    path = pack(f"{folder}/a.vcf.gz", TEXT + "no line feed at the end", (5_000,))
    found = packed_lines(spark, path, size=2_000)
    assert found.rdd.getNumPartitions() == -(-os.path.getsize(path) // 2_000) > 5
    assert values(found) == sorted([*TEXT.splitlines(), "no line feed at the end"])
    assert {r.file for r in found.select("file").distinct().collect()} == {f"file://{path}"}


def test_a_block_start_inside_of_data(folder):
    inner = block(b"a" * 50).replace(b"\n", b"")
    text = b"\n".join([b"first", inner, b"middle", inner + b" end", b"last", b""])
    path = f"{folder}/a.gz"
    with open(path, "wb") as out:
        for at in range(0, len(text), 70):
            out.write(block(text[at : at + 70], level=0))
    for size in (30, 64, 100, 10_000):
        assert read_ranges("file:" + path, size, text=False) == text.split(b"\n")[:-1]


def test_line_ends_at_a_block_end(folder):
    path = pack(f"{folder}/a.gz", "".join(f"{i:09}\n" for i in range(300)), (10, 20))
    for size in (1, 36, 37, 500):
        assert read_ranges("file:" + path, size) == [f"{i:09}" for i in range(300)]


def test_plain_gzip_is_one_task(spark, folder):
    with open(f"{folder}/a.gz", "wb") as out:
        for part in (TEXT[:5000], TEXT[5000:]):  # several members
            out.write(gzip.compress(part.encode()))
    assert values(packed_lines(spark, folder, size=300)) == sorted(TEXT.splitlines())
    with open(f"{folder}/a.gz", "ab") as out:
        out.write(gzip.compress(b"cut")[:-4])
    with pytest.raises(Exception, match="ends within a gzip member"):
        packed_lines(spark, folder).collect()


def test_damaged_blocks_are_named(spark, folder):
    path = pack(f"{folder}/a.gz", TEXT, (9_000,))
    data = bytearray(open(path, "rb").read())
    with open(f"{folder}/b.gz", "wb") as out:
        out.write(data[:-40])
    with pytest.raises(Exception, match="b.gz: no whole block at byte"):
        packed_lines(spark, f"{folder}/b.gz").collect()
    at = block_gzip.member_size(bytes(data)) - 6
    data[at] ^= 1
    with open(f"{folder}/c.gz", "wb") as out:
        out.write(data)
    with pytest.raises(Exception, match="c.gz: wrong checksum of the block at byte 0"):
        packed_lines(spark, f"{folder}/c.gz").collect()
    data[at] ^= 1
    third = len(block(TEXT[:9_000].encode())) + len(block(TEXT[9_000:18_000].encode()))
    data[third + block_gzip.member_size(bytes(data), third) - 6] ^= 1
    with open(f"{folder}/d.gz", "wb") as out:
        out.write(data)
    for size in (third, third - 5, 50, 1 << 20):  # the damaged block is a range's first or not
        with pytest.raises(ValueError, match=f"d.gz: wrong checksum of the block at byte {third}"):
            read_ranges(f"file:{folder}/d.gz", size)


def test_heads(spark, folder):
    pack(f"{folder}/a.vcf.gz", "##one\n#CHROM\tx\n" + TEXT + "#late\n", (7, 300))
    with open(f"{folder}/b.vcf", "w") as out:
        out.write("##two\r\n#CHROM\ty\r\n" + TEXT)
    open(f"{folder}/empty.vcf", "w").close()
    assert values(head_lines(spark, folder)) == ["##one", "##two", "#CHROM\tx", "#CHROM\ty"]


def test_genotypes_equal_those_of_plain_text(spark, study, folder):
    first = 96_521_657
    pick = random.Random(1)
    calls = ["0|0", "0|1", "1|1", "./.", "1", "0/1:3"]
    records = [
        record(first + n // 2, *(pick.choice(calls) for _ in range(30)), ref=pick.choice("AG"), alt="T")
        for n in range(400)
    ]
    samples = [f"S{i}" for i in range(30)]
    os.mkdir(f"{folder}/plain"), os.mkdir(f"{folder}/packed")
    plain = variant_file(f"{folder}/plain", "a.vcf", samples, *records[:300])
    variant_file(f"{folder}/plain", "b.vcf", samples[::-1], *records[300:])
    pack(f"{folder}/packed/a.vcf.gz", open(plain).read(), (800, 33))
    variant_file(f"{folder}/packed", "b.vcf", samples[::-1], *records[300:])
    wanted = panel(spark, *samples[:20])
    expected = rows(variant_files.read_genotypes(spark, f"{folder}/plain", wanted, study))
    assert rows(variant_files.read_genotypes(spark, f"{folder}/packed", wanted, study)) == expected
    assert len(expected) > 2000
